"""Personal data by pattern and by weak supervision, in built-in expressions only.

Base kinds are fixed patterns with a test. Beside them, tokens with digits, whatever token follows a word
that announces a secret, and groups shaped as account or social security numbers are candidates for
secrets (keys, passwords, tokens, PINs): regex, gazetteer and context labelers vote on each, the
votes of all candidates are counted by pattern, expectation-maximisation over the counts
estimates how reliable each labeler is, and its posteriors are the soft labels to which a
logistic classifier over shape and context is fitted. The classifier finds the added spans.

The patterns start only where a run of their characters starts or the last match ended, and
take runs possessively: the same matches as the plain patterns, without trying each place of a
long run and without recursion. Places are running sums, overlaps running maxima, both over blocks, and a
text is cut through blocks, so the time for a text with n matches grows as n log n.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ADDED = "secret"
NUMBER = "number"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
CONTEXT_CHARS = 24
SCAN_BLOCK = 256
BLOCK_CHARS = 1024  # of a text that is cut at many places
THRESHOLD = 0.5

# Words that announce a secret.
GAZETTEER = ("password", "passwd", "passphrase", "pwd", "token", "secret", "apikey", "api_key", "api-key",
             "key", "auth", "bearer", "credential", "login", "pin", "ssn", "iban", "passport", "account")
_WORDS = "|".join(GAZETTEER)
_IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
# Candidates: pattern, what a text has to have for it, kind.
CANDIDATES = {
    "token": (r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9]|A[KS]IA[A-Z]|gh[a-z]_|sk-)[A-Za-z0-9_/+-]{8,}+", "", ADDED),
    "named": (rf"(?<![^\s\"'=:])(?<=\b(?i:{_WORDS})[\s\"':=]{{1,4}}(?:is\s{{1,2}})?[\"']{{0,1}})(?!(?i:{_WORDS})\b)[^\s\"',;<>()]{{3,}}+",
              rf"\b(?i:{_WORDS})[\s\"':=]", ADDED),
    "group": (rf"(?<![A-Za-z0-9])(?:{_IBAN}|{_SSN})(?![A-Za-z0-9])", "", NUMBER),
}


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _is_valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(bare(p)) <= 3) & (
            F.coalesce(bare(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """Running sums (or the like) of an array of longs.

    Appending copies what is there, so only blocks of SCAN_BLOCK values are scanned that way; their
    totals are scanned in turn and added to the blocks.
    """
    def step(acc: Column, x: Column) -> Column:
        so_far = F.when(F.size(acc) == 0, x).otherwise(combine(x, F.element_at(acc, -1)))
        return F.array_append(acc, so_far)

    def short(block: Column) -> Column:
        return F.aggregate(block, F.array().cast("array<long>"), step)

    def blocks(v: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(v), F.lit(SCAN_BLOCK))
        return F.transform(first, lambda i: short(F.slice(v, i, SCAN_BLOCK)))

    def put_together(parts: Column) -> Column:
        totals = _running(F.transform(parts, lambda p: F.element_at(p, -1)), combine, levels - 1)
        moved = lambda t: F.flatten(F.transform(parts, lambda p, b: F.when(b == 0, p).otherwise(
            F.transform(p, lambda x: combine(x, F.get(t, b - 1))))))
        return _let(totals, moved)

    if not levels:
        return short(values)
    return _let(values, lambda v: F.when(F.size(v) <= SCAN_BLOCK, short(v)).otherwise(_let(blocks(v), put_together)))


def _spans(matches: str, pieces: str, valid: Callable[[Column, Column], Column], kind: str,
           place: int) -> Column:
    """Spans of the valid matches. matches: the texts; pieces: what lies between them."""
    empty = F.array().cast("array<struct<start: long, back: long, place: int, kind: string, end: long>>")
    n = F.size(F.col(matches))
    length = lambda i: F.length(F.get(F.col(matches), i))
    steps = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (F.length(F.get(F.col(pieces), i)) + length(i)).cast("long"))

    def spans(ends: Column) -> Column:
        def span(end: Column, i: Column) -> Column:
            ok = valid(F.get(F.col(matches), i), F.get(F.col(pieces), i))
            return F.when(ok, F.struct((end - length(i)).alias("start"), (-end).alias("back"), F.lit(place).alias("place"),
                                       F.lit(kind).alias("kind"), end.alias("end")))

        return F.array_compact(F.transform(ends, span))

    return F.when(n > 0, _let(_running(steps, lambda x, y: x + y), spans)).otherwise(empty)


def _found(rows: DataFrame, name: str, pattern: str, needs: Column | None) -> DataFrame:
    """Add m_name, the matches in text, and p_name, the texts between them."""
    everything = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    if needs is not None:
        everything = F.when(needs, everything).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn(f"m_{name}", everything)
    return rows.withColumn(f"p_{name}", F.when(F.size(f"m_{name}") > 0, F.split("text", pattern, -1)))


def _with_candidates(rows: DataFrame) -> DataFrame:
    for name, (pattern, needs, _) in CANDIDATES.items():
        rows = _found(rows, name, pattern, F.col("text").rlike(needs) if needs else None)
    return rows


# Labelers and features of a candidate, from its text and the text before it.

def _context(piece: Column) -> Column:
    return F.lower(F.right(piece, F.lit(CONTEXT_CHARS)))


_NAMED = r"(?:^|[^a-z])(?:" + _WORDS + r")[\s\"':=-]*(?:is\s*)?[\s\"']*$"
_STATED = r"(?:[=:]|\bis)\s?[\"']?$"


def _told(m: Column, c: Column) -> Column:
    """Whether a word or the grouping tells what it is: length and mixture of characters then say nothing against it."""
    return c.rlike(_NAMED) | m.rlike(f"^(?:{_IBAN}|{_SSN})$")


_VOTE = {
    # regex labelers
    "key_shape": lambda m, c: F.when(m.rlike("^(?:AKIA|ASIA|AIza|sk-|ghp_|xox[a-z]-)[A-Za-z0-9_-]{8,}$"), 1)
    .when(m.rlike(f"^(?:{_IBAN}|{_SSN})$"), 1)
    .when(m.rlike("^[a-z]+[0-9]{1,4}$|^[0-9]{1,4}[a-z]+$"), -1).otherwise(0),
    "hex": lambda m, c: F.when(m.rlike("^(?=.*[a-f])[0-9a-f]{12,}$"), 1)
    .when(m.rlike("^[0-9/-]+$") & ~_told(m, c), -1).otherwise(0),
    # gazetteer labeler
    "named": lambda m, c: F.when(c.rlike(_NAMED), 1).otherwise(0),
    # context labelers
    "assigned": lambda m, c: F.when(c.rlike("[a-z][a-z_-]*\\s?[=:]\\s?[\"']?$"), 1)
    .when(c.rlike("(?:no|nr|page|version|year|chapter|number)[.:]?\\s$"), -1).otherwise(0),
    "long": lambda m, c: F.when(F.length(m) >= 16, 1).when((F.length(m) < 10) & ~_told(m, c), -1).otherwise(0),
    "mixed": lambda m, c: F.when(m.rlike("[A-Za-z][0-9]+[A-Za-z]+[0-9]"), 1)
    .when(~m.rlike("[0-9][A-Za-z]") & ~_told(m, c), -1).otherwise(0),
    "stated": lambda m, c: F.when(c.rlike(_STATED), 1).when(m.rlike("^[A-Za-z]?[a-z]+[.!?]?$"), -1).otherwise(0),
}
_FEATURE = {
    "upper": lambda m, c: m.rlike("[A-Z]"),
    "lower": lambda m, c: m.rlike("[a-z]"),
    "long": lambda m, c: F.length(m) >= 16,
    "short": lambda m, c: F.length(m) < 12,
    "half_digits": lambda m, c: 2 * F.length(_digits(m)) >= F.length(m),
    "few_digits": lambda m, c: 5 * F.length(_digits(m)) < F.length(m),
    "turns": lambda m, c: m.rlike("[A-Za-z][0-9]+[A-Za-z]+[0-9]"),
    "parts": lambda m, c: m.rlike("[_/+-]"),
    "named": lambda m, c: c.rlike(_NAMED),
    "assigned": lambda m, c: c.rlike("[=:]\\s?[\"']?$"),
    "stated": lambda m, c: c.rlike(_STATED),
    "word": lambda m, c: m.rlike("^[A-Za-z]?[a-z]+[.!?]?$"),
    "number": lambda m, c: m.rlike(f"^(?:{_IBAN}|{_SSN})$"),
}


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200,
                  smooth: float = 1.0) -> list[float]:
    """Posterior of each vote pattern by EM; starts from the sum of the votes."""
    if not patterns:
        return []
    p = [1 / (1 + math.exp(-sum(votes) * 1.5 + 0.5)) for votes, _ in patterns]
    n_labelers = len(patterns[0][0])
    for _ in range(rounds):
        on = sum(q * c for q, (_, c) in zip(p, patterns, strict=True)) + smooth
        off = sum((1 - q) * c for q, (_, c) in zip(p, patterns, strict=True)) + smooth
        weight = []
        for k in range(n_labelers):
            table = {}
            for v in (-1, 0, 1):
                a = sum(q * c for q, (votes, c) in zip(p, patterns, strict=True) if votes[k] == v)
                b = sum((1 - q) * c for q, (votes, c) in zip(p, patterns, strict=True) if votes[k] == v)
                table[v] = math.log((a + smooth / 3) / on) - math.log((b + smooth / 3) / off)
            weight.append(table)
        before = p
        p = [1 / (1 + math.exp(-max(-500.0, min(500.0, math.log(on / off) + sum(
            t[v] for t, v in zip(weight, votes, strict=True)))))) for votes, _ in patterns]
        if max(abs(a - b) for a, b in zip(before, p, strict=True)) < 1e-6:
            break
    return p


def logistic(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 500,
             penalty: float = 1e-3) -> tuple[float, list[float]]:
    """Bias and weights for (features, count, share of positives) by gradient descent."""
    if not rows:
        return -1e3, [0.0] * len(_FEATURE)
    n, total = len(rows[0][0]), sum(c for _, c, _ in rows)
    bias, weights = 0.0, [0.0] * n
    for _ in range(rounds):
        slope_bias, slope = 0.0, [penalty * w for w in weights]
        for features, count, share in rows:
            z = bias + sum(w for w, f in zip(weights, features, strict=True) if f)
            error = (1 / (1 + math.exp(-max(-500.0, min(500.0, z)))) - share) * count / total
            slope_bias += error
            for i, f in enumerate(features):
                if f:
                    slope[i] += error
        bias -= 2.0 * slope_bias
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return bias, weights


@dataclass(frozen=True)
class Model:
    bias: float
    weights: list[float]

    def is_secret(self, m: Column, piece: Column) -> Column:
        z = F.lit(self.bias)
        for w, feature in zip(self.weights, _FEATURE.values(), strict=True):
            z = z + F.when(feature(m, _context(piece)), F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z)) >= THRESHOLD


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Reliabilities and classifier from all candidates of all texts.

    Only counts by vote and feature pattern reach the driver: at most 3 ** 7 * 2 ** 13 rows,
    of which few occur.
    """
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    zipped = [F.transform(F.arrays_zip(F.col(f"m_{n}").alias("m"), F.slice(F.coalesce(f"p_{n}", F.array().cast(
        "array<string>")), 1, F.size(f"m_{n}")).alias("p")), lambda x: F.struct(x["m"], x["p"])) for n in CANDIDATES]
    each = _with_candidates(rows).select(F.explode(F.concat(*zipped)).alias("x")).select(
        F.col("x.m").alias("m"), _context(F.col("x.p")).alias("c"))
    votes = [f(F.col("m"), F.col("c")).alias(f"vote_{k}") for k, f in _VOTE.items()]
    features = [f(F.col("m"), F.col("c")).cast("int").alias(f"has_{k}") for k, f in _FEATURE.items()]
    names, has = [f"vote_{k}" for k in _VOTE], [f"has_{k}" for k in _FEATURE]
    counted = each.select(*votes, *features).groupBy(*names, *has).count().collect()
    by_votes: dict[tuple[int, ...], int] = {}
    for row in counted:
        key = tuple(row[n] for n in names)
        by_votes[key] = by_votes.get(key, 0) + row["count"]
    patterns = sorted(by_votes.items())
    p = dict(zip((votes for votes, _ in patterns), reliabilities(patterns), strict=True))
    sums: dict[tuple[int, ...], list[float]] = {}
    for row in sorted(counted, key=tuple):
        share = sums.setdefault(tuple(row[n] for n in has), [0.0, 0.0])
        share[0] += row["count"]
        share[1] += row["count"] * p[tuple(row[n] for n in names)]
    return Model(*logistic([(k, c, s / c) for k, (c, s) in sorted(sums.items())]))


def with_spans(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """kept0, kept1 and so on, text, and spans in order of their start; place tells base spans (0 to 3) from added ones."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)],
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    for kind in KINDS:
        rows = _found(rows, kind, PATTERNS[kind], F.contains("text", F.lit(NEEDS[kind])) if NEEDS[kind] else None)
    rows = _with_candidates(rows)
    found = [_spans(f"m_{k}", f"p_{k}", lambda m, piece, k=k: _is_valid(k, m), k, i) for i, k in enumerate(KINDS)]
    found += [_spans(f"m_{n}", f"p_{n}", model.is_secret, kind, len(KINDS) + i)
              for i, (n, (_, _, kind)) in enumerate(CANDIDATES.items())]
    def not_inside(every: Column) -> Column:
        # What is used within a function of an element is a variable: a column would be computed for each element.
        def kept(reach: Column) -> Column:
            return F.filter(every, lambda s, i: (s["place"] < len(KINDS)) | (i == 0) | (F.get(reach, i - 1) < s["end"]))

        return _let(_running(F.transform(every, lambda s: s["end"]), F.greatest), kept)

    # By start, longer ones and base kinds first: what lies in another span comes after it.
    spans = F.transform(_let(F.sort_array(F.concat(*found)), not_inside),
                        lambda s: F.struct(s["start"], s["place"], s["kind"], s["end"]))
    rows = rows.withColumn("spans", F.sort_array(spans))
    return rows.select(*[f"kept{i}" for i in range(len(keep))], "text", "spans")


def _base(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["place"] < len(KINDS))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, a count of each base kind, base_sha256, spans, n_added of each row of docs.

    Null and empty texts have no spans. No added span lies in a base one or in another added one. A text may be of any
    length and have any number of matches. Repeated rows are
    treated alike; other columns are ignored whatever their names; an empty table gives no rows.
    Names, postal addresses and dates of birth are not looked for.
    """
    found = with_spans(docs, fit(docs, text), [doc_id], text).withColumn("base", _base(F.col("spans")))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("kept0").cast("long").alias("doc_id"), *map(count, KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def _between(blocks: Column, begin: Column, end: Column) -> Column:
    """The text from begin to end (code points), out of its blocks."""
    block = lambda at: F.floor(at / BLOCK_CHARS).cast("int")
    rest = lambda at: (at % BLOCK_CHARS).cast("int")
    first, last = F.get(blocks, block(begin)), F.get(blocks, block(end))
    inside = F.substring(first, rest(begin) + 1, (end - begin).cast("int"))
    across = F.concat(F.substring(first, rest(begin) + 1, F.lit(BLOCK_CHARS)),
                      F.array_join(F.slice(blocks, block(begin) + 2, block(end) - block(begin) - 1), ""),
                      F.coalesce(F.substring(last, F.lit(1), rest(end)), F.lit("")))
    return F.when(end <= begin, "").when(block(begin) == block(end), inside).otherwise(across)


def masked(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """docs with every span replaced by its kind in brackets, and n_chars counted anew.

    Overlapping spans become one, named by the first. A null text stays null.
    """
    names = docs.columns
    found = with_spans(docs, fit(docs, text), names, text)
    blocks = F.when(F.size("spans") > 0, F.regexp_extract_all(
        "text", F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0)))
    length = F.length("text").cast("long")

    def replaced(blocks: Column) -> Column:
        def with_reach(reach: Column) -> Column:
            # The spans that begin behind all before them, and where what they begin ends.
            numbered = F.transform("spans", lambda s, i: F.struct(i.alias("i"), s["start"].alias("start"), s["kind"].alias("kind")))
            ahead = F.filter(numbered, lambda s: (s["i"] == 0) | (F.get(reach, s["i"] - 1) <= s["start"]))

            def piece(s: Column) -> Column:
                before = F.when(s["i"] == 0, F.lit(0).cast("long")).otherwise(F.get(reach, s["i"] - 1))
                return F.concat(_between(blocks, before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))

            tail = _between(blocks, F.element_at(reach, -1), length)
            return F.concat(F.array_join(F.transform(ahead, piece), ""), tail)

        return _let(_running(F.transform("spans", lambda s: s["end"]), F.greatest), with_reach)

    own = F.col(f"kept{names.index(text)}")
    clean = F.when(F.size("spans") > 0, _let(blocks, replaced)).otherwise(own)
    rows = found.withColumn(f"kept{names.index(text)}", clean)
    if n_chars in names:
        at = f"kept{names.index(n_chars)}"
        rows = rows.withColumn(at, F.coalesce(F.length(own).cast(docs.schema[n_chars].dataType), F.col(at)))
    return rows.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(names)])
