import hashlib
import random
import re

import pytest

from sheafwork.llm import pii
from tests.llm import data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    values = [int(x) * (1 + k % 2) for k, x in enumerate(reversed(text))]
    return sum(x // 10 + x % 10 for x in values) % 10 == 0


def plain(text):
    """Strict spans by the patterns themselves."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [
        ("card", *m.span())
        for m in CARD.finditer(text)
        if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))
    ]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


TEXTS = [
    "mail a.b@c.de, x@y.z@w.v and @a.b or a@b, a@-.-",
    "a@b.c@d.e.f..g@h.i.",
    "ip 1.2.3.4.5.6.7.8.9 and 256.1.1.1 or 1.1.1.256.3.3.3.3 001.02.3.4.",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111  1111 1111 1111 4111111111111111",
    "tel +1 (406) 555-0113. +49--30 +1 +12 345 6789 01234567890",
    'token = "ca66aed31166840e05a33b5fd7e3392164164ca2" password=dd2c17a84ad219891c',
    "joe (at) example (dot) com; call 555 123 4567",
    "É\U0001f600 kssgpls.21@mail1.example.com ٣.٣.٣.٣",
]


def rows():
    more = data.texts() + [(300 + k, text) for k, text in enumerate(TEXTS)]
    rng = random.Random(5)
    more += [(400 + k, "".join(rng.choice("@@..12+ -()ab4%") for _ in range(60))) for k in range(300)]
    return more + [(900, "a" * 200_000 + "@"), (901, "1" * 200_000), (902, "+1" * 100_000), (903, "1." * 100_000)]


@pytest.mark.parametrize("text", [text or "" for _, text in rows()])
def test_strict_spans(text):
    if len(text) < 50_000:
        assert pii.strict_spans(text) == plain(text)


def test_report(spark):
    given = [(i, t) for i, t in rows() if len(t or "") < 50_000]
    found = pii.proposed(data.documents(spark, given))
    result = sorted((tuple(row) for row in pii.report(found, pii.fit(found)).collect()), key=repr)
    assert len(result) == len(given)
    by_id = {i: t or "" for i, t in given}
    for doc_id, *counts, digest, spans, _ in result:
        base = plain(by_id[doc_id])
        assert counts == [sum(s[0] == kind for s in base) for kind in pii.BASE_KINDS]
        assert digest == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert set(filter(None, pii.listed(base).split(","))) <= set(spans.split(","))


def test_long_texts_take_linear_time(spark):
    found = pii.proposed(data.documents(spark, rows()))
    assert pii.report(found, pii.fit(found)).count() == len(rows())


def test_given_documents_are_redacted(spark):
    docs = spark.read.parquet(f"{data.SF_DIR}/documents.parquet")
    clean = pii.redact(docs)
    assert clean.schema == docs.schema
    texts = [row.text for row in clean.collect()]
    assert not any(plain(text) for text in texts)
    assert any("<EMAIL>" in text for text in texts)


def test_secrets_are_added(spark):
    docs = data.documents(spark, rows()[: -4])
    model = pii.fit(pii.proposed(docs))
    spans = pii.accepted(pii.proposals(TEXTS[5]), model, 0.5)
    assert [TEXTS[5][a:b] for _, a, b in spans] == [
        "ca66aed31166840e05a33b5fd7e3392164164ca2",
        "dd2c17a84ad219891c",
    ]


def test_reliabilities_are_estimated():
    """Labelers of known quality are told apart without labels."""
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.4
        right = [0.95, 0.9, 0.8, 0.7, 0.5]
        votes = "".join("+" if truth == (rng.random() < p) else "-" for p in right)
        counts[votes + "00"] = counts.get(votes + "00", 0) + 1
    model = pii._fit([("card", pattern, count) for pattern, count in counts.items()])
    learnt = model.reliability["card"][1, :, 2]
    assert abs(model.prior["card"] - 0.4) < 0.05
    assert all(abs(x - y) < 0.05 for x, y in zip(learnt, [0.95, 0.9, 0.8, 0.7, 0.5]))
    assert model.probability("card", "+++++00") > 0.9 > 0.1 > model.probability("card", "-----00")


def test_no_rows(spark):
    found = pii.proposed(data.documents(spark, []))
    assert pii.report(found, pii.fit(found)).collect() == []
    assert pii.redact(data.documents(spark, [])).collect() == []


def test_secrets_are_whole_and_need_no_other_words():
    token = "eyJhbGci" * 60
    for text, value in (("token=" + token + " end", token), ("password: hunterfoxes", "hunterfoxes")):
        assert [(k, text[a:b]) for (k, a, b), *_ in pii.proposals(text)] == [("secret", value)]
    colons = ":".join(["face"] * 8)
    assert [(k, colons[a:b]) for (k, a, b), *_ in pii.proposals(colons)] == [("ip", colons)]


def test_addresses_written_out():
    for text in ("Joe.B [AT] Example.org", "joe at mail dot example dot com", "j { at } x dot de", "a <at> b (dot) fr"):
        assert [(k, text[a:b]) for (k, a, b), *_ in pii.proposals(text)] == [("email", text)]
    for text in ("we met at noon dot", "look at this. that", "at", " dot ", "(at) (dot)"):
        assert pii.proposals(text) == []


def planted(seed, number):
    """Texts with wider spans, true ones and others that look alike."""
    rng = random.Random(seed)

    def some(size, of="0123456789"):
        return "".join(rng.choice(of) for _ in range(size))

    def name():
        return some(rng.randrange(4, 9), "abcdefghiklmnoprstuvw")

    def card():
        bare = "4" + some(14)
        return next(bare + x for x in "0123456789" if luhn(bare + x))

    makers = [
        ("email", True, lambda: rng.choice(["mail to ", "contact ", "write "]), lambda: f"{name()} (at) {name()}.{rng.choice(['com', 'de', 'org'])}"),
        ("email", True, lambda: "contact ", lambda: f"{name()} at {name()} dot {rng.choice(['com', 'fr'])}"),
        ("email", False, lambda: "we met ", lambda: f"{name()} (at) {name()}.{name()}"),
        ("phone", True, lambda: rng.choice(["call ", "phone ", "tel "]), lambda: f"({some(3)}) {some(3)}-{some(4)}"),
        ("phone", False, lambda: rng.choice(["part no ", "version ", "isbn "]), lambda: f"{some(3)}-{some(2)}-{some(4)}-{some(2)}"),
        ("secret", True, lambda: "export token=", lambda: some(24, "abcdef0123456789")),
        ("secret", True, lambda: "set api_key: ", lambda: some(32, "ABCDEFGHKLMNPQ23456789")),
        ("secret", False, lambda: "the password: ", lambda: rng.choice(["changeme", "undefined", "placeholder"])),
        ("ip", True, lambda: rng.choice(["login from ", "server "]), lambda: ":".join(some(4, "123456789abcdef") for _ in range(8))),
        ("card", True, lambda: "karte ", lambda: card()),
    ]
    out = []
    for _ in range(number):
        text, true, false = name(), set(), set()
        for kind, is_true, before, body in rng.sample(makers, 3):
            text += f". {name()} {before()}"
            start = len(text)
            text += body()
            (true if is_true else false).add((kind, start, len(text)))
            text += f" {name()} {name()}"
        out.append((text, true, false))
    return out


def test_planted_spans_are_told_apart(spark):
    """Trained without labels on one half, measured on the other."""
    train, held_out = planted(1, 600), planted(2, 600)
    docs = data.documents(spark, [(k, text) for k, (text, _, _) in enumerate(train)])
    model = pii.fit(pii.proposed(docs))
    found = right = wanted = 0
    for text, true, _ in held_out:
        spans = set(pii.accepted(pii.proposals(text), model, 0.5))
        found, right, wanted = found + len(spans), right + len(spans & true), wanted + len(true)
    print("precision", right / found, "recall", right / wanted)
    assert right >= 0.95 * found and right >= 0.95 * wanted


def test_context_decides_where_votes_do_not():
    """The same votes, other words around: what the votes taught the words is used."""
    rows = [("phone", "-+0++33", 50), ("phone", "-+0-+33", 50), ("phone", "-+00+33", 100)]
    call, part = (pii.context(f"{word} 555 123 4567", ("phone", 5, 17)) for word in ("call", "part"))
    sample = [("phone", "-+0++33", call)] * 4 + [("phone", "-+0-+33", part)] * 4
    model = pii._fit(rows, sample)
    assert model.probability("phone", "-+00+33", call) > model.probability("phone", "-+00+33", part)


def test_sample_is_bounded(spark):
    """However many spans a pattern has, and with rows of one id, SAMPLE of them train."""
    docs = data.documents(spark, [(k % 50, f"call (406) 555-{1000 + k} now") for k in range(400)])
    one, two = pii.fit(pii.proposed(docs)), pii.fit(pii.proposed(docs.repartition(7)))
    assert (one.weights == two.weights).all()
    assert (one.weights != 0).sum() <= pii._CONTEXT_AT + pii.SAMPLE * 40
