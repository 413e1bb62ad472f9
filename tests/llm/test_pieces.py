from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from pulsegrain.llm import pieces
from pulsegrain.llm.pieces import Vocabulary, encode_texts, encoded, read_pieces
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = [prose(1, 200), "hello  world", " a", "a ", "", "  ", "日本語 😀 x\x00", "\n\n a\tb", "a" * 90,
         "xy" * 40 + " " + "z" * 33, "ab " + " " * 40 + "c", "Ünïcödé ñandú Straße", "<s></s><unk>", None]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(*read_pieces(MODEL))


def lists(vocabulary, texts, dropout, variant=0):
    out = []
    for _, ids, bounds in encode_texts(vocabulary, pa.array(texts, pa.string()), np.full(len(texts), variant), 11, dropout):
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def test_without_dropout_it_is_the_library(vocabulary):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert lists(vocabulary, TEXTS, 0.0) == [library.encode(t or "") for t in TEXTS]


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_any_segmentation_decodes(vocabulary, dropout):
    texts = [*TEXTS, "a▁b ▁▁ c", "▁"]
    for text, ids in zip(texts, lists(vocabulary, texts, dropout), strict=True):
        assert vocabulary.decode(np.array(ids, np.int32)) == (text or "")


def test_segmentations_vary_with_variant_and_repeat_with_seed(vocabulary):
    one, again, other = (lists(vocabulary, TEXTS, 0.2, v) for v in (0, 0, 1))
    assert one == again != other
    assert sum(map(len, one)) > sum(map(len, lists(vocabulary, TEXTS, 0.0)))


def agenda(vocabulary, word, key, limit):
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    return vocabulary.merge_word(vocabulary.chars[codes].tolist(), int(key), limit)


@pytest.mark.parametrize("rows", [16_384, 97, 1])
def test_lockstep_and_agenda_agree(vocabulary, monkeypatch, rows):
    """Each occurrence ends where the agenda ends with its key, however they are put together."""
    words = sorted({" " + w for w in prose(6, 120).split()} | {
        " international", " a", " ", "  q", "x", "xyxyxyxyxyxyxyxyxyxyxy", " " + "ab" * 16, "é" * 40, " 日本語日本語日本"})
    n = 4000 if rows > 1 else 150
    sequence = np.arange(n) % len(words)
    keys = pieces.mix(np.arange(n, dtype=np.uint64))
    monkeypatch.setattr(pieces, "LOCKSTEP_ROWS", rows)
    for dropout in (0.0, 0.1, 0.4, 1.0):
        expected = [agenda(vocabulary, words[w], k, int(dropout * 2**53)) for w, k in zip(sequence, keys)]
        expected = [vocabulary._with_bytes(np.array(e, np.int32), np.array([0, len(e)]))[0].tolist() for e in expected]
        ids, begins = vocabulary.encode_words(pa.array([w.encode() for w in words], pa.binary()), sequence, keys, dropout)
        assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == expected


def test_batches_do_not_matter(vocabulary, monkeypatch):
    whole = lists(vocabulary, TEXTS, 0.2)
    monkeypatch.setattr(pieces, "BATCH_BYTES", 1)
    assert lists(vocabulary, TEXTS, 0.2) == whole


def test_words_of_texts():
    texts = ["hello  world ", "", " a", " ", None, "é  \n b", "   "]
    some, = pieces.texts_of(pa.array(texts, pa.string()))
    words, sequence, bounds = pieces.words_in(some)
    found = [[words[int(w)].as_py().decode() for w in sequence[a:b]] for a, b in zip(bounds[:-1], bounds[1:])]
    assert found == [[" hello", "  world", " "], [], ["  a"], ["  "], [], [" é", "  \n", " b"], ["    "]]


def test_many_pairs_in_one_slot_are_found(vocabulary):
    for pair, piece in list(vocabulary.pairs.items())[::37]:
        a, b = np.array([pair // vocabulary.n]), np.array([pair % vocabulary.n])
        assert vocabulary.joined(a, b)[0] == piece
    assert vocabulary.joined(np.array([-1, 5]), np.array([3, -7])).tolist() == [-1, -1]


def test_rows(spark):
    rows = hard_documents()
    found = encoded(clashing(frame(spark, rows)), MODEL).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in found)
    assert encoded(nothing(frame(spark, rows)), MODEL).count() == 0


def test_every_occurrence_is_cut_by_its_own_key(spark):
    """One word many times in a document, in many documents, and a document taken twice."""
    text = " ".join(["international"] * 300)
    rows = [(i, text, "en", "a", len(text)) for i in range(40)]
    found = {r.doc_id: r.token_ids for r in encoded(frame(spark, rows), MODEL).collect()}
    assert len({tuple(ids) for ids in found.values()}) == 40
    from pyspark.sql import functions as F

    docs = frame(spark, rows).withColumn("take", F.explode(F.array(F.lit(0), F.lit(1))))
    twice = encoded(docs, MODEL, take="take").collect()
    assert len({tuple(r.token_ids) for r in twice}) == 80
    assert all(r.round_trip for r in twice)


def test_places_of_a_text_are_cut_apart(vocabulary):
    ids, = lists(vocabulary, [" ".join(["international"] * 300)], 0.3)
    starts = [i for i, t in enumerate(ids) if vocabulary.bytes[t].startswith(b" ")]
    words = {tuple(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)}
    assert len(words) > 8
