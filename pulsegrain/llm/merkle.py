"""Fingerprints of texts: a Merkle tree over sentences, paragraphs and sections.

A text is cut into sentences that give it back when joined: up to LONGEST characters and a run
of . ! ? and line ends behind them. A sentence that holds a line end closes its paragraph. A paragraph closes its section where a blank line
follows, or where the hash of its last sentence says so (one in four), so that an edit does
not move the borders of later sections. The digest of a branch is the SHA-256 of its children's digests.
Equal roots mean equal texts; where roots differ, only differing branches are looked into.

A fingerprint is written `root|section(leaf leaf,leaf)|section(...)`: 64 hex digits of the root, 16 of a
section, and for a sentence 10 digits of its hash, a colon and its length; paragraphs are
divided by commas. The likeness of two trees is Dice's coefficient of their distinct leaves, each
weighing its length in code points (up to 2^20 - 1): 1 for equal roots, 0 without a common sentence.

All of it is built-in functions over arrays: linear in the text, no Python, one shuffle of the texts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 128  # code points of a sentence before its stops; what is longer is cut
SENTENCE = f"[^.!?\n]{{1,{LONGEST}}}[.!?\n]*|[.!?\n]+"
MOST = (1 << 20) - 1
RANGE_ROWS = 2000  # documents of one range of ids, about
MOST_RANGES = 1 << 17  # beyond them ranges get longer


def _steps(text: str, name: str) -> list[list[str]]:
    """Columns <name>_leaves, _paragraphs, _sections, _root and _keys of a text column, step by step."""
    leaves, paragraphs, sections = (f"{name}_{x}" for x in ("leaves", "paragraphs", "sections"))

    def groups(items: str, closes: str, made: str) -> str:
        # Where groups end, then a slice for each: linear, unlike appending.
        return f"""transform(array({items}), all -> transform(
          transform(array(filter(sequence(1, size(all)), k -> size(all) > 0 AND (k = size(all) OR all[k - 1].{closes}))),
                    e -> transform(e, (end, i) -> struct(if(i = 0, 0, e[i - 1]) AS start, end)))[0],
          s -> transform(array(slice(all, s.start + 1, s.end - s.start)), g -> {made})[0]))[0]"""

    def joined(items: str, field: str, by: str = "") -> str:
        return f"array_join(transform({items}, x -> x.{field}), '{by}')"

    return [
        [f"""transform(regexp_extract_all({text}, r'{SENTENCE}', 0), p -> named_struct(
           'd', sha2(p, 256), 'n', least(char_length(p), {MOST}), 'closes', contains(p, '\\n'),
           'blank', contains(p, '\\n\\n'))) AS {leaves}"""],
        [groups(leaves, "closes", f"""named_struct('d', sha2({joined('g', 'd')}, 256),
           'closes', g[size(g) - 1].blank OR substring(g[size(g) - 1].d, 1, 1) IN ('0', '1', '2', '3'),
           'code', array_join(transform(g, x -> concat(substring(x.d, 1, 10), ':', x.n)), ' '))""")
         + f" AS {paragraphs}",
         f"""array_distinct(transform({leaves}, x ->
           CAST(conv(substring(x.d, 1, 10), 16, 10) AS BIGINT) * {MOST + 1} + x.n)) AS {name}_keys"""],
        [groups(paragraphs, "closes", f"""named_struct('d', sha2({joined('g', 'd')}, 256),
           'code', {joined('g', 'code', ',')})""") + f" AS {sections}"],
        [f"sha2({joined(sections, 'd')}, 256) AS {name}_root"],
    ]


def with_tree(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add the tree of a text column without nulls: <name>_sections, <name>_root and <name>_keys."""
    kept = docs.columns
    for step in _steps(f"`{text}`", name):
        docs = docs.selectExpr("*", *step)
    return docs.select(*[F.col(f"`{c}`") for c in kept], f"{name}_sections", f"{name}_root", f"{name}_keys")


def written_as(name: str) -> str:
    """The fingerprint of a tree."""
    return (f"concat({name}_root, array_join(transform({name}_sections, "
            f"s -> concat('|', substring(s.d, 1, 16), '(', s.code, ')')), ''))")


def likeness(a: str, b: str) -> str:
    """Dice's coefficient of two trees' leaves by their lengths."""
    def weight(keys: str) -> str:
        return f"aggregate({keys}, 0L, (sum, k) -> sum + (k & {MOST}))"

    return (f"CASE WHEN {a}_root = {b}_root THEN 1D ELSE 2 * CAST({weight(f'array_intersect({a}_keys, {b}_keys)')} "
            f"AS DOUBLE) / ({weight(f'{a}_keys')} + {weight(f'{b}_keys')}) END")


def edited_sections(a: str, b: str) -> str:
    """The first and last section (from 1) of a that differs from b, counted with equal starts and ends.

    Null where the roots are equal. Only digests of branches are compared.
    """
    def equal_branches(i: str) -> str:
        # How many branches agree from one end on; i is the place from that end.
        return (f"transform(array(array_position(transform(sequence(1, greatest(size({a}_sections), size({b}_sections))), "
                f"i -> {i}), false)), p -> if(p = 0, size({a}_sections), p - 1))[0]")

    start = equal_branches(f"coalesce(get({a}_sections, i - 1).d = get({b}_sections, i - 1).d, false)")
    end = equal_branches(f"coalesce(get({a}_sections, size({a}_sections) - i).d "
                         f"= get({b}_sections, size({b}_sections) - i).d, false)")
    # A repeated section may agree from both ends.
    return (f"if({a}_root = {b}_root OR size({a}_sections) = 0, NULL, named_struct('first', least({start}, size({a}_sections) - 1) + 1, "
            f"'last', greatest(size({a}_sections) - {end}, least({start}, size({a}_sections) - 1) + 1)))")


def _ranges(docs: DataFrame) -> list[int]:
    """Upper ends of ranges of ids with about as many documents each: ids that occur, the last the largest."""
    n = docs.where("doc_id IS NOT NULL").count()
    if not n:
        return []
    parts = min(MOST_RANGES, math.ceil(n / RANGE_ROWS))
    shares = [(i + 1) / parts for i in range(parts)]
    found = docs.select(F.percentile_approx("doc_id", shares, max(10_000, 4 * parts)).alias("ends"),
                        F.max("doc_id").alias("top")).first()
    return sorted({*found.ends, found.top})


def _range_of(ends: list[int]) -> str:
    """struct(part, end) of an id: the number of ends below it, and its range's end. Sought in two steps.

    A null id lies in range 0, below all.
    """
    if not ends:
        return "struct(0 AS part, CAST(NULL AS BIGINT) AS end)"

    def array(values: list[int]) -> str:
        return f"array({', '.join(f'CAST({v} AS BIGINT)' for v in values)})"

    width = max(1, math.isqrt(len(ends)))
    rows = [ends[i:i + width] for i in range(0, len(ends), width)]
    return f"""transform(array(size(filter({array([r[-1] for r in rows])}, t -> t < doc_id))),
        r -> transform(array(get(array({', '.join(map(array, rows))}), r)),
        w -> transform(array(size(filter(w, t -> t < doc_id))), c -> struct(r * {width} + c AS part, get(w, c) AS end))[0])[0])[0]"""


def by_range(docs: DataFrame) -> DataFrame:
    """doc_id, text, part, place: the documents (place 0) by ranges of ids, and copies that end a range.

    The first document of a range by falling id is copied to the range above it, where it comes
    after the last (place 1); the first of all also comes after the last of all (place 2).
    """
    ends = _ranges(docs)
    top = f"doc_id <=> CAST({ends[-1] if ends else 'NULL'} AS BIGINT)"
    return (docs.selectExpr("doc_id", "text", f"{_range_of(ends)} AS at")
            .selectExpr("doc_id", "text", f"""inline(filter(array(
                named_struct('part', at.part, 'place', 0),
                if(doc_id = at.end AND at.part < {len(ends) - 1}, named_struct('part', at.part + 1, 'place', 1), NULL),
                if({top}, named_struct('part', 0, 'place', 2), NULL)), x -> x IS NOT NULL))""")
            .repartition("part"))


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edit.

    The edited text has the last third of a text (rounded down) replaced by as many first code points of
    the next document by falling id, or all it has; after the last comes the first. edit: the sections in which
    the edited text differs. A null text is the empty one, which has no sections; null ids come last;
    documents of equal id are ordered by the hash of their text, so repeated rows follow each other
    and each gets its row. A single document follows itself. An empty table gives no rows; other columns are ignored
    whatever their names. A range of ids is put in order by one task, which spills to disk.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = with_tree(by_range(docs), "text", "own").withColumn("fingerprint", F.expr(written_as("own")))
    rows = rows.withColumn("own_sections", F.expr("transform(own_sections, s -> named_struct('d', s.d))"))
    order = Window.partitionBy("part").orderBy("place", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    rows = (rows.select("*", *[F.lead(c).over(order).alias(n) for c, n in
                               (("text", "next_text"), ("own_root", "next_root"), ("own_keys", "next_keys"))])
            .where("place = 0")
            .selectExpr("*", "CAST(char_length(text) AS BIGINT) AS n_chars"))
    edited = "concat(left(text, int(n_chars - n_chars div 3)), left(next_text, int(n_chars div 3)))"
    rows = rows.selectExpr("doc_id", "n_chars", "fingerprint", "own_root", "own_keys", "own_sections", "next_root",
                           "next_keys", f"{edited} AS edited")
    rows = with_tree(rows, "edited", "new")
    return rows.selectExpr("doc_id", "n_chars", "sha2(edited, 256) AS edited_sha256", "fingerprint",
                           f"{written_as('new')} AS edited_fingerprint", f"{likeness('own', 'new')} AS near_edited",
                           f"{likeness('own', 'next')} AS near_next", f"{edited_sections('own', 'new')} AS edit")
