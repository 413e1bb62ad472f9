from __future__ import annotations

import hashlib
import re
import time

from pulsegrain.llm.pii import masked, pii_report, reliabilities
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def valid(kind: str, m: str) -> bool:
    digits = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def base(text: str | None) -> list[str]:
    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if valid(k, m[0])]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


HARD = ["a@b.c_d@e.f x@y@z.w .@x.y.z", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.3.255 1.2.3 0000000001.0.0.0",
        "4111 1111 1111 1111\n4111-1111-1111-1112 12-", "+1 (988) 555-2485. +49 30 123456 +1....",
        "é😀 +1 (988) 555-2485 a.b@c.de", "1" * 30000, "a" * 100000, "+" * 1000 + "1 2 3 4 5 6 7 8 9 0",
        "a@b.c" * 500, "4111111111111111 " * 50, "%a@b-.c.-d @a.b a@ b@c", "1.1.1.1" * 300]


def documents() -> list[tuple]:
    words = re.sub("[0-9]", "", prose(3, 400)).split()
    secrets = [f'{" ".join(words[i:i + 20])} password={hashlib.md5(str(i).encode()).hexdigest()} {words[i]}'
               for i in range(40)]
    keys = [f'{" ".join(words[i:i + 20])} AKIA{hashlib.md5(str(i).encode()).hexdigest()[:16].upper()} end' for i in range(40)]
    plain = [f'{" ".join(words[i:i + 20])} chapter {1000000 + i * 37} of version20{i:02d} here' for i in range(80)]
    texts = [*HARD, *secrets, *keys, *plain]
    return [(1000 + i, t, "en", "a", len(t)) for i, t in enumerate(texts)]


def test_base_matches_brute_force_and_secrets_are_added(spark):
    rows = documents() + hard_documents()
    found = {r.doc_id: r for r in pii_report(clashing(frame(spark, rows))).collect()}
    for doc_id, text, *_ in rows:
        spans = base(text)
        got = found[doc_id]
        assert got.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k + ":") for s in spans) for k in PATTERNS]
        assert set(spans) <= set(got.spans.split(",")) | {""}
    for doc_id, text, *_ in documents()[len(HARD):]:
        secret = re.search("(?<=password=)[0-9a-f]+|AKIA[0-9A-F]+", text)
        spans = f"secret:{secret.start()}:{secret.end()}" if secret else ""
        assert spans in found[doc_id].spans and (secret or found[doc_id].n_added == 0)


def test_masked_text_has_none_left(spark):
    docs = clashing(frame(spark, documents() + hard_documents()))
    out = masked(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[1004].text == "é😀 [PHONE] [EMAIL]" and texts[1004].n_chars == len("é😀 [PHONE] [EMAIL]")
    assert texts[15].text is None and texts[0].text == hard_documents()[0][1]
    assert not re.search("AKIA|password=[0-9a-f]", " ".join(r.text or "" for r in texts.values()))


def brute_mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, pos = [], 0
    for i, (start, end, kind) in enumerate(spans):
        if i == 0 or start >= pos:
            out += [text[pos:start], f"[{kind.upper()}]"]
        pos = max(pos, end)
    return "".join(out) + text[pos:]


def test_masking_is_exact_in_long_texts_of_any_characters(spark):
    texts = [("é😀x" * 400 + " a.b@c.de 10.1.2.3 +49 (30) 123456789 ") * 9 + "tail", "a@b.cd" + "😀" * 5000,
             "x" * 1023 + " q@r.st", "x" * 1024 + "q@r.st", " ".join(["1.2.3.4", "u@v.wx"] * 3000), "u@1.2.3.4 z"]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    docs = frame(spark, rows)
    spans = {r.doc_id: [(int(a), int(b), k) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
             for r in pii_report(docs).collect()}
    for r in masked(docs).collect():
        assert r.text == brute_mask(texts[r.doc_id], spans[r.doc_id])
        assert r.n_chars == len(r.text)


def test_very_many_matches_in_one_text_take_seconds(spark):
    text = "u@v.wx 1.2.3.4 password=4f9a1c77b2e04d " * 50_000
    docs = frame(spark, [(1, text, "en", "a", len(text))], 1)
    begin = time.time()
    found = pii_report(docs).first()
    assert (found.n_email, found.n_ip) == (50_000, 50_000)
    assert found.base_sha256 == hashlib.sha256(",".join(base(text)).encode()).hexdigest()
    assert masked(docs).first().text.startswith("[EMAIL] [IP] ")
    assert time.time() - begin < 90


def test_words_that_announce_a_secret(spark):
    words = re.sub("[0-9]", "", prose(9, 400)).split()
    filler = [f"the key {words[i]} of chapter {1000000 + i * 37} in version20{i:02d} has account holders" for i in range(80)]
    secret = ["my password is hunter", "login pin: 4821 thanks", 'api_key = "zqk" or token: xkcdcorrecthorse',
              "pay to DE89 3704 0044 0532 0130 00 today", "ssn 078-05-1120 on file"]
    known = [f"password={hashlib.md5(str(i).encode()).hexdigest()} and pin: {1000 + 7 * i} or the password is {words[i]} "
             f"and ssn {100 + i}-{10 + i % 80}-{2000 + i} kept" for i in range(80)]
    texts = [*secret, *filler, *known]
    found = {r.doc_id: r for r in pii_report(frame(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])).collect()}
    def values(i):
        return {texts[i][int(a):int(b)] for k, a, b in (s.split(":") for s in found[i].spans.split(",") if s)}
    got = set().union(*map(values, range(len(secret))))
    assert got >= {"4821", "xkcdcorrecthorse"}, got
    assert all(not found[len(secret) + i].n_added for i in range(len(filler)))


def test_empty_table(spark):
    docs = nothing(frame(spark, documents()))
    assert pii_report(docs).count() == masked(docs).count() == 0


def test_reliabilities_trust_the_labelers_that_agree():
    p = reliabilities([((-1, -1, 0), 300), ((-1, -1, 1), 100), ((1, 1, 0), 80), ((1, 1, 1), 30), ((0, 1, 0), 5)])
    assert min(p[2:]) > 0.9 > 0.1 > max(p[:2])
