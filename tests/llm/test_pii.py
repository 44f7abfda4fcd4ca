import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The rules, straight from their definition."""
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def passes(d):
        total = 0
        for k, x in enumerate(reversed(d)):
            x = 2 * x if k % 2 else x
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and passes(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize(
    "text",
    [
        "",
        "mail a.b@c.d.e and x@y, @z.com, a@b@c.de",
        "a@b.c@d.e.f %@x-y.z",
        "10.0.0.1 256.1.1.1 1.2.3.4.5 001.002.003.0004 1.2.3",
        "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111113333",
        "+1 (017) 555-7713 +49.30.123456 +1 +12345678901234567",
        "call +1 (826) 555-4081 190.137.223.204 now",
        "ñ 日本 4845168114407329 é a@b.co",
    ],
)
def test_rules_follow_their_definition(text):
    assert pii.base_spans(text) == plain(text)


def test_rules_on_the_table(small_docs):
    for row in small_docs.collect():
        assert pii.base_spans(row["text"]) == plain(row["text"])


def test_long_runs_are_linear():
    assert pii.base_spans("1" * 200_000 + "." + "a" * 200_000 + "@") == plain("1" * 10) == []


def test_messages_are_exact_on_a_chain():
    """On a tree, message passing gives the marginals of the full joint distribution."""
    random = np.random.default_rng(1)
    n = pii.Nodes([0, 2, 4], [1, 3, 5], np.array([-1, 1, -1]), [[0, 1], [0, 2], [0, 3]], [(0, 1), (1, 2)], [])
    field = pii.Field(random.normal(size=(pii.FEATURES, 5)), random.normal(size=(5, 5)), np.zeros((5, 5)))
    alone = np.array([field.words[f].sum(axis=0) for f in n.features])
    joint = np.zeros((5, 5, 5))
    for a in range(5):
        for c in range(5):
            joint[a, 1, c] = np.exp(alone[0, a] + alone[2, c] + field.chain[a, 1] + field.chain[1, c])
    joint /= joint.sum()
    found = pii.marginals(n, field, rounds=200)
    assert np.allclose(found[0], joint.sum(axis=(1, 2)), atol=1e-3) and np.allclose(found[2], joint.sum(axis=(0, 1)), atol=1e-3)


def test_a_repeated_form_takes_the_label_of_its_twin():
    texts = [f"call +1 (0{k}7) 555-77{k}3 or write to u{k}@mail.example.com today {k}" for k in range(10, 60)]
    field = pii.fitted(texts)
    text = "call +1 (026) 555-4081 190.137.223.204 now"
    base, spans = pii.all_spans(text, field, sure=0.6)
    assert [k for k, _, _ in base] == ["ip"] and set(base) <= set(spans)
    assert ("phone" in [k for k, _, _ in spans])


def test_edges(edge_docs, no_docs):
    field = pii.fit(edge_docs)
    found = pii.find(edge_docs.withColumn("spans", F.lit(1)).withColumn("n_ip", F.lit(2)), field)
    assert found.count() == edge_docs.count()
    empty = found.where("doc_id = 1").first()
    assert (empty["n_email"], empty["spans"]) == (0, "")
    assert empty["base_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert pii.find(no_docs, pii.fit(no_docs)).count() == 0


def test_masking_hides_every_span(spark, edge_docs):
    docs = spark.createDataFrame([(1, "to a@b.co or 10.0.0.1", 9), (2, None, None)], "doc_id long, text string, n_chars long")
    rows = pii.masked(docs, pii.fitted([])).orderBy("doc_id").collect()
    assert rows[0]["text"] == "to [EMAIL] or [IP]" and rows[0]["n_chars"] == len(rows[0]["text"])
    assert rows[1]["text"] is None
