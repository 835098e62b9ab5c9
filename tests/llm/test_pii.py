from __future__ import annotations

import hashlib
import math
import random
import re

from larder.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """Base spans by the plain patterns."""
    text = text or ""
    found = [(m.start(), 0, m.end(), "email")
             for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 14 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))]
    found += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


PARTS = [
    "ann@mail.example", "@", ".", "a.b", "_", "c@d.e_f@g.h", "+1 (555) 010-2345", "+", "4539 1488 0343 6467",
    "4539148803436467", "-", " ", "255.0.010.1", "256.1.1.1", "1.2.3.4.5", "0", "7", "é", "😀", "(", ")", "\n", "%x",
]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(8)
    texts = [None, "", "9" * 60_000, "a." * 30_000, "x@" + "a." * 20_000 + "b", "+1" + "(" * 50_000, "0" * 300 + "1.1.1.1"]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.scan(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain(text)
        base = [s for s in got[i].spans.split(",") if s and s.split(":")[0] in pii.KINDS]
        assert base == want, text
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(s.startswith(k) for s in want) for k in pii.KINDS]


def corpus(spark):
    """One address that always goes with a rare name, among common words."""
    rows = [(i, f"on day {'abcdefgh'[i]}{'qrs' * (i + 1)} mister Zebulon wrote from zeb@mail.example to the office again")
            for i in range(6)]
    rows += [(100 + i, f"the office wrote again to mister number {i} on day one") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_disclosing_word_is_sanitised_and_common_ones_stay(spark):
    docs = corpus(spark)
    spans = {r.doc_id: r.spans for r in pii.scan(docs).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    for i in range(6):
        start = text[i].index("Zebulon")
        assert f"name:{start}:{start + 7}" in spans[i].split(",")
        assert not any(s.startswith(("term", "number")) for s in spans[i].split(",") if "Zeb" in s)
    assert all(spans[100 + i] == "" for i in range(200))
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "Zebulon" not in clean[0] and "<name>" in clean[0] and "<email>" in clean[0] and "office" in clean[0]
    assert clean[100] == text[100]


def test_a_rare_name_beside_an_address_in_two_texts_is_sanitised_everywhere(spark):
    far = " ".join(["common words of every text"] * 30)
    rows = [(i, f"Barnaby number {'xyz' * (i + 1)} wrote. {far}. Mail bar@mail.example please") for i in range(2)]
    rows += [(50, f"mail old@mail.example or Quentin. {far}")]
    rows += [(100 + i, f"number wrote please mail {far} {'klm' * (i + 1)}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = {r.doc_id: r.text for r in docs.collect()}
    hidden = {r.doc_id: {text[r.doc_id][int(s.split(":")[1]):int(s.split(":")[2])] for s in r.spans.split(",") if s}
              for r in pii.scan(docs).collect()}
    assert all({"Barnaby", "bar@mail.example"} <= hidden[i] for i in range(2))
    assert hidden[50] == {"old@mail.example"}
    assert not {"common", "words", "number", "wrote", "please"} & set().union(*hidden.values())
    more = docs.union(spark.createDataFrame([(9999, "so Barnaby came alone " + far)], docs.schema))
    spans = pii.scan(more.union(spark.createDataFrame(
        [(2000 + i, f"Barnaby again at bar@mail.example {far} {'npq' * (i + 1)}") for i in range(9)], docs.schema)))
    assert spans.where("doc_id = 9999").first().spans == "name:3:10"


def test_copies_of_one_passage_are_one_surrounding(spark):
    docs = spark.createDataFrame(
        [(i, "ask Barnaby at bar@mail.example now") for i in range(50)] + [(99, "other words are here as well")],
        "doc_id long, text string")
    assert {r.spans for r in pii.scan(docs).where("doc_id < 99").collect()} == {"email:15:31"}


def test_empty_table_null_ids_and_clashing_names(spark):
    kind = "doc_id long, text string, row int, near string, email int"
    assert pii.scan(spark.createDataFrame([], kind)).collect() == []
    rows = pii.scan(spark.createDataFrame([(None, "a@b.c", 1, "n", 2), (None, "a@b.c", 1, "n", 2)], kind)).collect()
    assert [r.spans for r in rows] == ["email:0:5"] * 2


def brute_pairs(texts):
    """Terms that disclose some address, by counting over the distinct texts."""
    own = {}
    for text in set(texts):
        spans = [tuple(map(int, s.split(":")[1:])) for s in plain(text)]
        bare = "".join(" " if any(a <= i < b for a, b in spans) else c for i, c in enumerate(text))
        own[text] = ({text[a:b] for a, b in spans}, {w.lower() for w in re.findall(r"[^\W\d_][^\W_]{2,}", bare)})
    found = set()
    for entity in set().union(*(e for e, _ in own.values())):
        with_entity = [t for t, (e, _) in own.items() if entity in e]
        for term in set().union(*(own[t][1] for t in with_entity)):
            n = sum(term in words for _, words in own.values())
            both = sum(term in own[t][1] for t in with_entity)
            share, z = both / n, pii.Z
            low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            if low >= pii.DISCLOSURE and math.log2(low / (len(with_entity) / len(own))) >= pii.LEAST_BITS:
                found.add(term)
    return found


def hidden_words(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = set()
    for r in pii.scan(docs).collect():
        for s in filter(None, r.spans.split(",")):
            kind, start, end = s.split(":")
            if kind in pii.TERM_KINDS:
                found.add(texts[r.doc_id][int(start):int(end)].lower())
    return found


def test_disclosing_words_equal_counting_by_hand(spark, monkeypatch):
    rng = random.Random(3)
    names = [f"name{c}" for c in "abcdefgh"]
    texts = []
    for _ in range(300):
        words = rng.choices([f"word{c}{d}" for c in "abcdefghij" for d in "klmnop"], k=6)
        if rng.random() < 0.2:
            i = rng.randrange(8)
            words += [f"p{i}@mail.example"] + ([names[i]] if rng.random() < 0.8 else [])
        elif rng.random() < 0.05:
            words.append(rng.choice(names))
        texts.append(" ".join(words))
    texts += texts[:40]
    want = brute_pairs(texts)
    assert want and hidden_words(spark, texts) == want
    monkeypatch.setattr(pii, "BROADCAST_KEYS", 0)
    assert hidden_words(spark, texts) == want


def test_unrelated_texts_and_single_ones_change_no_verdict(spark):
    texts = [f"Barnaby wrote {c * 4} to bar@mail.example" for c in "xyz"] + ["write gooseberry to one@mail.example"]
    for n in (100, 1_000, 5_000):
        found = hidden_words(spark, texts + [f"plain unrelated words {i}" for i in range(n)])
        assert found == {"barnaby", "wrote"}
