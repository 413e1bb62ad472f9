"""Cheapest repair of conversations by a suffix-shared automaton of their signatures.

Rows become one letter each: the initial of the role, upper case where the text is truncated, or
x for a row that has to go. The letters of a conversation are cut, from its end, into signatures of at most
SEGMENT letters, and the distinct signatures of all conversations form a DAWG that is minimised from the
end: a node is a distinct suffix, so what conversations end alike in is one path. For
a node and a state of the grammar the cheapest edits to each state behind the suffix, and of equally cheap
ones the least audit, follow from the next node; they are computed once for all conversations. The nodes
are visited in the order of reversed signatures, so a task holds one path of at most SEGMENT nodes.

A conversation then takes its segments' tables from the end (cost to go) and applies the choices
from the start. Both passes stream over sorted rows and hold one segment, so a conversation may
be of any length. It stays in one task, as the SHA-256 over its repaired text cannot be split.

Texts are shuffled once, for that hash; all else works on digests, letters and positions.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.llm.shared import written

SEGMENT = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)  # grammar states: what came last
STATES = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
         (USER, "a"): ASSISTANT}
WANTED = {START: "u", SYSTEM: "u", ASSISTANT: "u", USER: "a"}  # what a new or changed role has to be
ROLES = {"u": "user", "a": "assistant"}
# Edits after the last row: what it takes to end with an answer, or with nothing.
ENDINGS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
Table = list[list[tuple[int, str] | None]]  # by state before and state behind: cost and audit
BEHIND_ALL: Table = [[(0, "") if s == t else None for t in STATES] for s in STATES]
_ROW = re.compile("I*[DKR]")
SPACES = " \t\n\x0b\x0c\r"


def before(letter: str, following: Table) -> Table:
    """The table of the node that letter leads to following's node from."""
    plain: Table = []
    role, more = letter.lower(), TRUNCATED if letter.isupper() else 0
    for state in STATES:
        edits = [("D", DELETE, state)]
        if letter != "x":
            edits.append(("R", REROLE + more, AFTER[state, WANTED[state]]))
            if (state, role) in AFTER:
                edits.append(("K", KEEP + more, AFTER[state, role]))
        plain.append([min(((cost + following[then][t][0], edit + following[then][t][1])
                           for edit, cost, then in edits if following[then][t]), default=None)
                      for t in STATES])
    out: Table = []
    for state in STATES:
        # Two insertions reach every state that insertions can reach.
        one = AFTER[state, WANTED[state]]
        chain = [(0, "", state), (INSERT, "I", one), (2 * INSERT, "II", AFTER[one, WANTED[one]])]
        out.append([min(((cost + plain[s][t][0], edits + plain[s][t][1])
                         for cost, edits, s in chain if plain[s][t]), default=None) for t in STATES])
    return out


def tables(signatures: Iterator[str]) -> Iterator[tuple[str, Table]]:
    """The tables of signatures that come in the order of their reversed letters.

    Holds the nodes of the last signature; those that the next one shares are not computed again.
    """
    last, path = "", [BEHIND_ALL]
    for signature in signatures:
        shared = 0
        while shared < min(len(last), len(signature)) and last[-1 - shared] == signature[-1 - shared]:
            shared += 1
        del path[shared + 1:]
        for letter in signature[len(signature) - shared - 1::-1] if shared < len(signature) else "":
            path.append(before(letter, path[-1]))
        last = signature
        yield signature, path[-1]


def cheapest(table: Table, to_go: list[int]) -> list[tuple[int, int, str]]:
    """By state before a segment: cost to go, the state behind the segment, and its edits."""
    return [min((table[s][t][0] + to_go[t], table[s][t][1], t) for t in STATES if table[s][t])
            for s in STATES]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, gone, copies of every row; nulls of role and text are one space."""
    hit = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
                                     for c in ("conv_id", "turn")])) % 20
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (hit == 0).alias("gone"), F.when(hit == 3, 2).otherwise(1).alias("copies"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _rows(damage: DataFrame) -> DataFrame:
    """Every row after the damage with its fault and place, without its text."""
    ending = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    rows = damage.select("conv_id", "turn", "role", "digest", "gone", ending.alias("ending"),
                         F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    back = Window.partitionBy("conv_id").orderBy(
        "gone", F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"))
    rows = rows.select(
        "*", F.left("role", F.lit(1)).alias("initial"), F.row_number().over(back).alias("place"),
        F.lag("turn").over(back).alias("later_turn"), F.lag(F.left("role", F.lit(1))).over(back).alias("later"))
    earlier = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.desc("place"))
    blank, repeated = F.col("ending") == "", F.row_number().over(earlier) > 1
    rows = rows.withColumn("fault", F.when(blank, "blank").when(repeated, "duplicate")
                           .when(~F.col("ending").isin(".", "!", "?"), "truncated"))
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
              .when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter))
    legal = F.concat("initial", "later").isin("su", "ua", "au")
    return rows.select(
        "conv_id", "turn", "role", "digest", "place", letter.alias("letter"), "fault", "gone",
        F.when(F.col("gone"), -1).otherwise(F.expr(f"(place - 1) div {SEGMENT}")).alias("segment"),
        ((F.col("place") > 1) & ~legal).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("later_turn"))).alias("new_turn"))


def segments(damage: DataFrame) -> DataFrame:
    """conv_id, segment (from the end, -1: rows that were dropped), signature, rows, and counts."""
    live = ~F.col("gone")

    def count(flag) -> F.Column:
        return F.count(F.when(live & flag, 1))

    row = F.struct((-F.col("place")).alias("at"), "letter", "turn", "role", "digest")
    found = _rows(damage).groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(F.when(live, row))).alias("rows"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"), count(F.col("new_turn")).alias("turns"),
        F.min(F.when(live, F.col("turn"))).alias("first_turn"), F.max(F.when(live, F.col("turn"))).alias("last_turn"))
    return found.withColumn("signature", F.array_join(F.transform("rows", lambda r: r.letter), ""))


def automaton(signatures: DataFrame) -> DataFrame:
    """signature, costs and audits: its node's table, by 4 * state before + state behind (null: no way)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = (w for batch in batches for w in batch.column(0).to_pylist())
        done: list[tuple[str, Table]] = []

        def flush() -> pa.RecordBatch:
            flat = [[cell for line in table for cell in line] for _, table in done]
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in done]),
                 pa.array([[c and c[0] for c in f] for f in flat], pa.list_(pa.int32())),
                 pa.array([[c and c[1] for c in f] for f in flat], pa.list_(pa.string()))],
                ["signature", "costs", "audits"])

        for item in tables(words):
            done.append(item)
            if len(done) == 1000:
                yield flush()
                done.clear()
        if done:
            yield flush()

    distinct = signatures.select("signature").distinct().withColumn("back", F.reverse("signature"))
    ordered = distinct.repartitionByRange("back").sortWithinPartitions("back").select("signature")
    return ordered.mapInArrow(run, "signature string, costs array<int>, audits array<string>")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    buffer: list[dict] = []
    for record in records:
        buffer.append(record)
        if len(buffer) == 1000:
            yield pa.RecordBatch.from_pylist(buffer, schema)
            buffer = []
    yield pa.RecordBatch.from_pylist(buffer, schema)


def _from_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Choices of segments that come by conversation, the last one first."""
    def choices() -> Iterator[dict]:
        for _, lines in groupby(_records(batches), itemgetter("conv_id")):
            to_go = [ENDINGS[s][0] for s in STATES]
            for line in lines:
                cells = [c if c is None else (c, a) for c, a in zip(line["costs"], line["audits"], strict=True)]
                best = cheapest([cells[4 * s:4 * s + 4] for s in STATES], to_go)
                to_go = [cost for cost, _, _ in best]
                yield {"conv_id": line["conv_id"], "segment": line["segment"], "to_go": to_go,
                       "edits": [e for _, e, _ in best], "then": [t for _, _, t in best]}

    return _batches(choices(), pa.schema([("conv_id", pa.int64()), ("segment", pa.int32()),
                                          ("to_go", pa.list_(pa.int64())), ("edits", pa.list_(pa.string())),
                                          ("then", pa.list_(pa.int32()))]))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_DECIDED = ("conv_id long, last boolean, turn long, role string, digest binary, at long, edits string, gaps long, "
            "blank long, duplicate long, truncated long, illegal long, cost long")
_DECIDED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("last", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()),
    ("digest", pa.binary()), ("at", pa.int64()), ("edits", pa.string()), ("gaps", pa.int64()),
    *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64())])


def _from_the_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each row, and a last row with the counts, of segments that come the first one first."""
    def decisions() -> Iterator[dict]:
        for conv_id, lines in groupby(_records(batches), itemgetter("conv_id")):
            state, cost, turns, counts = START, None, 0, dict.fromkeys(_COUNTS, 0)
            low = high = None
            for line in lines:
                if not line["rows"]:
                    continue
                if cost is None:
                    cost = line["to_go"][START]
                edits = _ROW.findall(line["edits"][state])
                state = line["then"][state]
                for row, edit in zip(line["rows"], edits, strict=True):
                    yield {"conv_id": conv_id, "last": False, "turn": row["turn"], "role": row["role"],
                           "digest": row["digest"], "at": row["at"], "edits": edit}
                turns += line["turns"]
                for c in _COUNTS:
                    counts[c] += line[c]
                if line["first_turn"] is not None:
                    low = line["first_turn"] if low is None else min(low, line["first_turn"])
                    high = line["last_turn"] if high is None else max(high, line["last_turn"])
            yield {"conv_id": conv_id, "last": True, "edits": ENDINGS[state][1], "cost": cost or 0, **counts,
                   "gaps": 0 if low is None else high - low + 1 - turns}

    return _batches(decisions(), _DECIDED_ARROW)


_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
_RESULT_ARROW = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
                           ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _apply(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[dict]:
    """Per conversation its result, or (texts) each row of the repaired conversation."""
    for conv_id, lines in groupby(_records(batches), itemgetter("conv_id")):
        state, audit, place, digest, text = START, [], 0, hashlib.sha256(), ""
        for line in lines:
            if line["text"] is not None:
                text = line["text"]
                continue
            audit.append(line["edits"])
            for edit in line["edits"]:
                if edit == "D":
                    continue
                letter = line["role"][:1] if edit == "K" else WANTED[state]
                role = line["role"] if edit == "K" else ROLES[letter]
                state = AFTER[state, letter]
                kept = "" if edit == "I" else text
                if texts:
                    yield {"conv_id": conv_id, "place": place, "role": role, "text": kept, "edit": edit}
                else:
                    digest.update(f"{chr(10) if place else ''}{role}:{kept}".encode())
                place += 1
            if line["last"] and not texts:
                yield {**{c: line[c] for c in ("conv_id", "gaps", *_COUNTS, "cost")},
                       "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def _decided(conversations: DataFrame) -> DataFrame:
    """Texts and the edits of their rows, in order by conversation."""
    damage = damaged(conversations)
    found = written(segments(damage), "segments")
    nodes = automaton(found.where("segment >= 0"))
    taken = (found.where("segment >= 0").select("conv_id", "segment", "signature").join(nodes, "signature")
             .repartition("conv_id").sortWithinPartitions("conv_id", "segment")
             .select("conv_id", "segment", "costs", "audits"))
    chosen = taken.mapInArrow(_from_the_end, "conv_id long, segment int, to_go array<long>, edits array<string>, "
                              "then array<int>")
    # Choices meet their segments by sorting, so that null ids meet too.
    left = found.select(F.col("conv_id").alias("c"), F.col("segment").cast("int").alias("s"), "rows", "turns",
                        "first_turn", "last_turn", *_COUNTS)
    both = left.join(chosen, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("s") == F.col("segment")), "left")
    both = (both.select(F.col("c").alias("conv_id"), F.col("s").alias("segment"), "rows", "turns", "first_turn",
                        "last_turn", *_COUNTS, "to_go", "edits", "then")
            .repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment")))
    decisions = both.mapInArrow(_from_the_start, _DECIDED)
    texts = damage.where("not gone").select("conv_id", "turn", "role", "digest", "text",
                                            F.lit(False).alias("last"))
    # A text comes before the decisions on rows that have it.
    return (decisions.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
            .sortWithinPartitions("conv_id", "last", F.asc_nulls_first("turn"), "role", "digest",
                                  F.asc_nulls_first("at")))


def repair_report(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    Rows of one turn are taken by role and text digest. Null roles and texts are one space; rows
    with a null conv_id are one conversation; null turns come first. A conversation that loses all
    rows has zeros, an empty audit and the hash of nothing. A role outside s, u and a (by its first
    character; the empty role too) can be changed or deleted, not kept. Repeated rows are rows.
    An empty table gives no rows; other columns are ignored whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_apply(batches, False), _RESULT_ARROW)

    return _decided(conversations).mapInArrow(run, _RESULT)


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, place, role, text, edit (K, R or I) of each row of the repaired conversations."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("edit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_apply(batches, True), schema)

    return _decided(conversations).mapInArrow(run, "conv_id long, place long, role string, text string, edit string")
