from __future__ import annotations

import hashlib
import random
import re

from larder.llm import secret_scan

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(text):
    """Base spans by Python's own patterns."""
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


PARTS = [
    "password=", "Secret : ", "api_key", "APIKEY='", "token", ": ", "=", '"', "abc.", "12345678", "x" * 7, "AKIA",
    "AKIA" + "Z9" * 6, "0123456789abcdef" * 2, "deadbeef", "é", "😀", " ", "\n", "ſecret=abcdefgh", "toKen=longvalue99",
]


def some_texts(n=250):
    rng = random.Random(3)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(n)]


def test_base_spans_equal_plain_patterns(spark):
    texts = [None, "", "0" * 40_000, "token=" * 3_000, "a" * 100_000, *some_texts()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain(text)
        counts = [sum(k == kind for k, _, _ in want) for kind in secret_scan.KINDS]
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == counts, text
        assert got[i].base_sha256 == digest(want), text
        base = [s for s in got[i].spans.split(",") if s and not s.startswith("random")]
        assert base == [f"{k}:{a}:{b}" for k, a, b in want]


def random_token(rng, length=40):
    return "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=length))


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(5)
    words = ["internationalisation", "electroencephalograph", "path/to/some/long/file/name/in/here",
             "counterrevolutionaries", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa-bbbbbbbbbbbbbbb"]
    rows = [(i, f"see {w} here") for i, w in enumerate(words * 20)]
    keys = [random_token(rng) for _ in range(10)]
    rows += [(1000 + i, f"see {k} here") for i, k in enumerate(keys)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secret_scan.scan(docs).collect()}
    assert all(spans[i] == "" for i in range(100))
    assert sum(spans[1000 + i] == "random:4:44" for i in range(10)) >= 9


def test_redact_hides_secrets_and_leaves_the_rest(spark):
    docs = spark.createDataFrame(
        [(1, "é password = hunter2hunter2 end", "x", 31), (2, "clean", None, 5), (3, None, "y", None), (3, None, "y", None)],
        "doc_id long, text string, _token string, n_chars long")
    got = sorted(map(tuple, secret_scan.redact(docs, length_column="n_chars").collect()), key=str)
    assert got == sorted([
        (1, "é <secret:assign> end", "x", 21), (2, "clean", None, 5), (3, None, "y", None), (3, None, "y", None)], key=str)


def test_empty_table_null_ids_and_clashing_names(spark):
    kind = "doc_id long, text string, assign string, tokens int, at int, spans string"
    assert secret_scan.scan(spark.createDataFrame([], kind)).collect() == []
    one = secret_scan.scan(spark.createDataFrame([(None, "token: abcdefgh", "a", 1, 2, "s")], kind)).first()
    assert one.doc_id is None and one.n_assign == 1 and one.spans == "assign:0:15"
