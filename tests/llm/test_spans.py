"""Personal data and secrets against the patterns of the contract, tried in the plainest way."""

import hashlib
import random
import re
from collections import Counter

import pytest

from wardbook.llm import deobfuscation, secret_ledger
from wardbook.llm.spans import Span


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    back = [int(c) for c in number[::-1]]
    return (sum(back[::2]) + sum(sum(divmod(2 * c, 10)) for c in back[1::2])) % 10 == 0


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", 0, lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0, lambda m: 10 <= len(digits(m[0])) <= 15),
]
SECRETS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 32),
]


def plain(text, rules):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, flags, good) in enumerate(rules) for m in re.finditer(p, text, flags) if good(m)]
    return [Span(kind, a, b) for a, _, b, kind in sorted(found)]


def joined(spans):
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


PIECES = [
    "@", ".", "a", "b-c", "x.y", "1", "255", "256", "4111 1111 1111 1111", "4111-1111-1111-1111-1", "+1 (555) 123-4567", "+", " ", "-", "é",
    "10.0.0.1", "j@a.b", "token", "Secret", "password", "api_key", "APIKEY", "ſecret", ": ", "=", '"', "'", "abcdef12", "AKIA", "ABCDEF1234567890",
    "0123456789abcdef0123456789abcdef", "f", "K", "passwd:",
]


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        assert deobfuscation.detect(text) == plain(text, PERSONAL), text
        assert [s for s in secret_ledger.scan(text) if s.kind in secret_ledger.BASE_KINDS] == plain(text, SECRETS), text
        base, every = deobfuscation.find(text)
        assert base == deobfuscation.detect(text) and set(base) <= set(every)


@pytest.mark.parametrize("text,kind,hidden", [
    ("write to jane.doe (at) mail [dot] example (dot) org now", "email", "jane.doe (at) mail [dot] example (dot) org"),
    ("write to jane at example dot org now", "email", "jane at example dot org"),
    ("write to jane@example dot org now", "email", "jane@example dot org"),
    ("mail jаne＠exаmple．org!", "email", "jаne＠exаmple．org"),
    ("call plus one five five five one two three four five six seven today", "phone", "plus one five five five one two three four five six seven"),
    ("call +1 (５５５) 123-４567 today", "phone", "+1 (５５５) 123-４567"),
    ("host ten: one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
    ("card four one one one one one one one one one one one one one one one ok", "card", "four one one one one one one one one one one one one one one one"),
    ("call +1 five five five 123 4567 today", "phone", "+1 five five five 123 4567"),
    ("call +49 (three zero) 12 vier 45 678 today", "phone", "+49 (three zero) 12 vier 45 678"),
    ("host 192 dot 168 dot 0 dot 1 is up", "ip", "192 dot 168 dot 0 dot 1"),
    ("write to jane at example.org now", "email", "jane at example.org"),
    ("write to j.doe at mail.example.co.uk now", "email", "j.doe at mail.example.co.uk"),
    ("ip 10​.0.0.1 hidden", "ip", "10​.0.0.1"),
])
def test_disguises(text, kind, hidden):
    base, every = deobfuscation.find(text)
    start = text.index(hidden)
    assert not [s for s in base if s.kind == kind]
    assert Span(kind, start, start + len(hidden)) in every
    assert f"[{kind}]" in deobfuscation.masked(text) and hidden not in deobfuscation.masked(text)


@pytest.mark.parametrize("text", [
    "We met at noon, at the dot on the map.", "one two three four five six seven eight nine ten eleven",
    "Plus de vin, un deux trois.", "More is available at example.org, look at www.example.com/a for 10 dot 5.", "Visit us at example.org",
    "+1 for one or two of them", "version 1 dot 2 dot 3", "a score of 3 point 14 and 10 point 2", "look at this and that dot", "Ça été naïve, São Paulo, Straße.", "",
])
def test_clean_texts_stay_clean(text):
    assert deobfuscation.find(text) == ([], [])


def test_long_texts_take_time_in_proportion():
    for unit in ("a", "1", "1.", "@", "+1", "a@", "- ", "password ", "five "):
        text = unit * 200_000
        deobfuscation.find(text)
        secret_ledger.scan(text)


def test_personal_data_of_odd_rows(spark, odd):
    rows = deobfuscation.personal_data(odd).collect()
    want = Counter((r.doc_id, hashlib.sha256(joined(plain(r.text or "", PERSONAL)).encode()).hexdigest()) for r in odd.collect())
    assert Counter((r.id, r.base_sha256) for r in rows) == want
    assert deobfuscation.personal_data(odd.limit(0)).count() == 0


def test_ledger_scans_a_blob_once(spark, odd, tmp_path, monkeypatch):
    key = "token=abcdefgh1234"
    first = spark.createDataFrame([("a", key), ("b", key), ("c", "clean"), (None, key), ("a", key)], "path string, text string")
    ledger = secret_ledger.BlobLedger(spark, str(tmp_path / "ledger"))
    ledger.update(first, "path", "text")
    assert ledger.table().count() == 2
    found = {(r.path, tuple((s.kind, s.start, s.end) for s in r.findings)) for r in ledger.findings(first, "path", "text").collect()}
    assert found == {(p, (("assign", 0, len(key)),)) for p in ("a", "b", None)} | {("c", ())}
    assert ledger.findings(first, "path", "text").count() == 5

    later = spark.createDataFrame([("d", key), ("c", "clean now"), ("e", None)], "path string, text string")
    ledger.update(later, "path", "text")
    assert ledger.table().count() == 4
    ledger.update(later, "path", "text")
    assert ledger.table().count() == 4, "nothing was unseen"
    ledger.update(later, "path", "text", rule_version=2)
    assert ledger.table().groupBy("rule_version").count().collect() == [(1, 4), (2, 3)] or ledger.table().count() == 7
    ledger.update(odd, "doc_id", "text")
    assert ledger.findings(odd, "doc_id", "text").filter("findings IS NULL").count() == 0
