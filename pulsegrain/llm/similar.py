"""N-gram Jaccard join by prefix filters under several global token orders.

A text's set is its distinct word 5-grams (hashed to 64 bits). Two sets link when their
Jaccard similarity is at least PERCENT / 100. Then they share a token among the first
n - ceil(t n) + 1 of each set, whatever the order of all tokens, so a pair must pass this
test under every order: (1) rarest token first, (2) smallest hash first, (3) largest hash
first. Order 1 gives the candidates, 2 and 3 are tested before the sets are compared.

Copies of a set are one node. Sets of which less than t n tokens occur in any other set can
not link and leave before order 1 is computed. In a token's list all nodes are compared with
one pivot first; only nodes whose component is still another one are paired, so a family of
near copies costs a few comparisons a member and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.components import smallest_reachable
from pulsegrain.llm.packed import binary, by_parts, cut, part_of, runs, schema
from pulsegrain.llm.shared import partitions, written
from pulsegrain.llm.textarrays import (
    LOWER_VALUES, gram_hashes,
    mix, running, short_hash, span_hashes, texts_of, words_of)

SHINGLE = 5
PERCENT = 75
FLUSH_TOKENS = 1 << 20
_EMPTY = np.zeros(0, np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of an Arrow column, in row order."""
    for texts in texts_of(column):
        words = words_of(texts)
        hashes = span_hashes(running(texts.data, LOWER_VALUES), words.starts, words.ends)
        grams = gram_hashes(hashes, SHINGLE)
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(grams[a:b - SHINGLE + 1])
            elif b > a:
                yield short_hash(hashes[a:b]).reshape(1)
            else:
                yield _EMPTY


def signature(tokens: np.ndarray) -> int:
    """One 64-bit value of a whole set, as a signed integer."""
    total = np.sum(mix(tokens ^ np.uint64(0xA5A5A5A55A5A5A5A)), dtype=np.uint64, keepdims=True)
    return int(mix(total + np.uint64(len(tokens))).view(np.int64)[0])


def set_sizes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles and the signature of the set, null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig = [], []
            for tokens in shingle_sets(batch.column(1)):
                n.append(len(tokens))
                sig.append(signature(tokens) if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64())],
                ["doc_id", "n_shingles", "sig"])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, sig long")


def _tokens_by_part(sets: list[np.ndarray], sigs: list[int], n_parts: int) -> pa.RecordBatch:
    """Tokens of several sets by hash range: their low bytes, whose they are, how many."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order, cuts = cut(part_of(tokens, n_parts))
    low, owner, sig_of = tokens[order].astype(np.uint32), owner[order], np.array(sigs, np.int64)
    rows = []
    for part, a, b in cuts:
        at, lengths = runs(owner[a:b])
        rows.append((part, low[a:b], sig_of[owner[a:b][at]], lengths.astype(np.uint32)))
    return binary(rows, ["keys", "whose", "counts"])


def _shared_in_part(keys: np.ndarray, whose: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that have tokens of another one, and how many."""
    sigs, index = np.unique(whose, return_inverse=True)
    owner = np.repeat(index, counts)
    order = np.argsort(keys)
    keys, owner = keys[order], owner[order]
    starts, lengths = runs(keys)
    several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
    mask = np.repeat(several, lengths)
    pairs = np.unique(np.repeat(np.arange(len(starts)), lengths)[mask] * len(sigs) + owner[mask])
    shared = np.bincount(pairs % len(sigs), minlength=len(sigs))
    some = np.flatnonzero(shared)
    return sigs[some], shared[some]


def shared_counts(docs: DataFrame, text: str) -> DataFrame:
    """sig, shared: tokens of each set that another set has too.

    Every token goes to the task of its hash range once, packed, four bytes of it: two tokens
    of a range are taken for one in about 1 of 1,500 cases, which can only keep a set for the
    exact steps. A frequent token is one entry for each task and set; sums come back packed.
    """
    n_parts = partitions(docs.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        sets, sigs, held = [], [], 0
        for batch in batches:
            for tokens in shingle_sets(batch.column(0)):
                if not len(tokens) or (sig := signature(tokens)) in sent:
                    continue
                sent.add(sig)
                sets.append(tokens)
                sigs.append(sig)
                held += len(tokens)
                if held >= FLUSH_TOKENS:
                    yield _tokens_by_part(sets, sigs, n_parts)
                    sets, sigs, held = [], [], 0
        if sets:
            yield _tokens_by_part(sets, sigs, n_parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (keys, whose, counts) in by_parts(batches):
            sigs, shared = _shared_in_part(np.frombuffer(keys, np.uint32), np.frombuffer(whose, np.int64),
                                           np.frombuffer(counts, np.uint32))
            order, cuts = cut(part_of(sigs.view(np.uint64), n_parts))
            sigs, shared = sigs[order], shared[order].astype(np.uint32)
            yield binary([(part, sigs[a:b], shared[a:b]) for part, a, b in cuts], ["sigs", "shared"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (sigs, shared) in by_parts(batches):
            sigs, index = np.unique(np.frombuffer(sigs, np.int64), return_inverse=True)
            total = np.bincount(index, np.frombuffer(shared, np.uint32), len(sigs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(total)], ["sig", "shared"])

    packed = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(
        split, schema(["keys", "whose", "counts"]))
    counted = packed.repartitionById(n_parts, F.col("part")).mapInArrow(
        count, schema(["sigs", "shared"]))
    return counted.repartitionById(n_parts, F.col("part")).mapInArrow(add, "sig long, shared long")


def live_sets(docs: DataFrame, live: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node, n, tokens of the sets in live (sig, node)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([signature(t) if len(t) else None for t in found], pa.int64()),
                 pa.array([len(t) for t in found], pa.int64()),
                 pa.array([t.view(np.int64) for t in found], pa.list_(pa.int64()))],
                ["node", "sig", "n", "tokens"])

    # The ids alone are a small table more often than with the signatures.
    ids = written(live.select("node"), "live_ids")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text"))
    sets = written(texts.join(ids, "node").mapInArrow(
        run, "node long, sig long, n long, tokens array<long>"), "sets")
    if sets.count() > ids.count():  # ids that occur in several rows
        sets = written(sets.join(live.select("node", "sig"), ["node", "sig"]).dropDuplicates(["node"]), "sets")
    return sets.select("node", "n", "tokens")


def rare_prefixes(sets: DataFrame) -> DataFrame:
    """token, node, n, single, place: the prefix of each set under order 1.

    single: the tokens that no other set has; they come first in the order and are left out.
    place: of the token in the order. Tokens are counted in the task of their hash range and
    go back, with their counts, to the task of their set.
    """
    n_parts = partitions(sets.sparkSession)
    names = ["tokens", "df", "nodes", "sizes", "counts"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            nodes, sizes, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            tokens = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(nodes)), lists.value_lengths().to_numpy())
            order, cuts = cut(part_of(tokens, n_parts))
            tokens, owner, rows = tokens[order], owner[order], []
            for part, a, b in cuts:
                at, lengths = runs(owner[a:b])
                own = owner[a:b][at]
                rows.append((part, tokens[a:b], nodes[own], sizes[own], lengths.astype(np.uint32)))
            yield binary(rows, ["tokens", "nodes", "sizes", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (tokens, nodes, sizes, counts) in by_parts(batches):
            tokens, nodes = np.frombuffer(tokens, np.uint64), np.frombuffer(nodes, np.int64)
            sizes = np.frombuffer(sizes, np.int64)
            owner = np.repeat(np.arange(len(nodes)), np.frombuffer(counts, np.uint32))
            _, index, df = np.unique(tokens, return_inverse=True, return_counts=True)
            df = df[index]
            several = df > 1
            tokens, df, owner = tokens[several], df[several].astype(np.uint32), owner[several]
            home = part_of(mix(nodes.view(np.uint64)), n_parts)
            order, cuts = cut(home[owner])
            tokens, df, owner, rows = tokens[order], df[order], owner[order], []
            for part, a, b in cuts:
                at, lengths = runs(owner[a:b])
                own = owner[a:b][at]
                rows.append((part, tokens[a:b], df[a:b], nodes[own], sizes[own], lengths.astype(np.uint32)))
            yield binary(rows, names)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (tokens, df, nodes, sizes, counts) in by_parts(batches):
            tokens, df = np.frombuffer(tokens, np.uint64), np.frombuffer(df, np.uint32)
            counts = np.frombuffer(counts, np.uint32)
            node = np.repeat(np.frombuffer(nodes, np.int64), counts)
            size = np.repeat(np.frombuffer(sizes, np.int64), counts)
            order = np.lexsort((tokens, df, node))
            tokens, node, size = tokens[order], node[order], size[order]
            at, lengths = runs(node)
            single = size - np.repeat(lengths, lengths)
            place = single + np.arange(len(node)) - np.repeat(at, lengths)
            keep = place < size - (PERCENT * size + 99) // 100 + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[keep].view(np.int64)),
                 *[pa.array(x[keep].astype(np.int64)) for x in (node, size, single, place)]],
                ["token", "node", "n", "single", "place"])

    packed = sets.mapInArrow(split, schema(["tokens", "nodes", "sizes", "counts"]))
    counted = packed.repartitionById(n_parts, F.col("part")).mapInArrow(
        count, schema(names))
    return counted.repartitionById(n_parts, F.col("part")).mapInArrow(
        choose, "token long, node long, n long, single long, place long")


def _may_link(a: str, b: str) -> str:
    """SQL: sizes fit, and what is left behind the common token is enough for the overlap."""
    need = f"{PERCENT} * ({a}n + {b}n)"  # (100 + PERCENT) times the least overlap
    return (f"100 * least({a}n, {b}n) >= {PERCENT} * greatest({a}n, {b}n) AND "
            f"{100 + PERCENT} * least({a}n - {a}place, {b}n - {b}place) >= {need}")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, component, other) of which a and b share a prefix token under orders 2
    and 3 and are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(4), batch.column(5)
            keep = []
            for i in range(len(batch)):
                x, y = (c.slice(i, 1).flatten().to_numpy().view(np.uint64) for c in (left, right))
                if similar(x, y):
                    keep.append(i)
            yield batch.select(range(4)).take(pa.array(keep, pa.int64()))

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "component", "other", "x", "y")
            .mapInArrow(run, "a long, b long, component long, other long"))


def prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets link: prefixes under two orders first, then the whole sets."""
    p, q = prefix_length(len(x)), prefix_length(len(y))
    if not _common(x[:p], y[:q]) or not _common(x[-p:], y[-q:]):
        return False
    common = _common(x, y)
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _relabelled(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """node, component after components took over the label of the one they were linked to.

    Each component has one link at most, so two steps along the links are two small joins. Nodes
    with the same label are connected; that some connected ones still differ only costs
    comparisons.
    """
    step = found.select("component", "other")
    jump = step.join(step.select(F.col("component").alias("other"), F.col("other").alias("beyond")),
                     "other", "left").select("component", F.coalesce("beyond", "other").alias("root"))
    new = jump.select(F.col("component").alias("node"), F.col("root").alias("component"))
    if labels is None:
        return written(new, "labels")
    moved = labels.join(jump, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return written(moved.union(new.join(labels.select("node"), "node", "left_anti")), "labels")


def links_between(sets: DataFrame, rounds: int = 3) -> DataFrame:
    """Links (a, b) that connect all sets which links connect; not each link in a component.

    In each round a token's pivot is the set with the fewest tokens of its own, the likely
    origin of a family, and each component is compared with the pivot that it shares the most
    tokens with: one comparison a component. Components that still share a token are then
    paired in full.
    """
    prefixes = written(rare_prefixes(sets), "prefixes")
    links = tried = sets.sparkSession.createDataFrame([], "a long, b long")
    labels = None
    for turn in range(rounds + 1):
        if labels is None:
            open_ = prefixes.withColumn("component", F.col("node"))
        else:
            rows = prefixes.join(labels, "node", "left").withColumn(
                "component", F.coalesce("component", "node"))
            mixed = (rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                     .where("lo <> hi").select("token"))
            open_ = written(rows.join(mixed, "token"), "open")
            if open_.isEmpty():
                break
        cols = ("node", "n", "place", "component")
        if turn < rounds:
            rank = F.struct((1000 * F.col("single") / F.col("n")).cast("long").alias("own"),
                            F.xxhash64("node").alias("hash"), *cols)
            other = open_.groupBy("token").agg(F.min(rank).alias("p")).select(
                "token", *[F.col("p")[c].alias(f"p_{c}") for c in cols])
        else:
            other = open_.select("token", *[F.col(c).alias(f"p_{c}") for c in cols])
        pairs = open_.join(other, "token").where("component <> p_component AND " + _may_link("", "p_"))
        if turn == rounds:
            pairs = pairs.where("node < p_node")
        pairs = pairs.select("component", F.col("p_component").alias("other"), F.least("node", "p_node").alias("a"),
                             F.greatest("node", "p_node").alias("b"))
        if turn:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        if turn < rounds:
            best = F.struct("count", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"), "other")
            pairs = (pairs.groupBy("component", "other", "a", "b").count().groupBy("component")
                     .agg(F.max(best).alias("m"))
                     .select((-F.col("m.x")).alias("a"), (-F.col("m.y")).alias("b"), "component", "m.other"))
        else:
            pairs = pairs.dropDuplicates(["a", "b"])
        pairs = written(pairs.select("a", "b", "component", "other"), "pairs")
        found = written(verified(pairs, sets), "verified")
        links, tried = links.union(found.select("a", "b")), tried.union(pairs.select("a", "b"))
        if turn < rounds:
            labels = _relabelled(labels, found)
    return links


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest doc_id that links reach.

    Null and empty texts have no shingle and stand alone, as do rows without doc_id, whose
    component is null. Repeated rows stay rows and get the same component. Other columns are
    ignored whatever their names; an empty table gives no rows.
    """
    sizes = written(set_sizes(docs, doc_id, text), "sizes")
    nodes = (sizes.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig")
             .agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n")))
    live = written(nodes.join(shared_counts(docs, text), "sig")
                   .where(f"100 * shared >= {PERCENT} * n").select("sig", "node"), "live")
    component = smallest_reachable(links_between(live_sets(docs, live, doc_id, text)))
    of_sig = nodes.join(component, "node", "left").select(
        "sig", F.coalesce("component", "node").alias("component_id"))
    return (sizes.join(of_sig, "sig", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
                    .alias("component_id")))


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs without those that a smaller doc_id of their group stands for.

    Of repeated rows with words one stays; rows without words or without doc_id all stay.
    """
    found = similar_documents(docs, doc_id, text)
    verdict = written(found.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(
        (F.min("component_id") < F.col("doc_id")).alias("goes"), F.count("*").alias("copies"))
        .where("goes OR copies > 1"), "verdict")
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(names)])
    key, words = f"kept{names.index(doc_id)}", f"kept{names.index(text)}"
    stay = rows.join(verdict, F.col(key).cast("long") == F.col("doc_id"), "left_anti")
    repeated = verdict.where("NOT goes").select("doc_id")
    if not repeated.isEmpty():
        again = rows.join(repeated, F.col(key).cast("long") == F.col("doc_id")).drop("doc_id")
        has_words = F.coalesce(F.col(words), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
        stay = stay.unionAll(again.where(~has_words)).unionAll(
            again.where(has_words).dropDuplicates([key]))
    return stay.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(names)])
