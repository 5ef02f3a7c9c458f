"""Secret scan and personal data: base spans against the plain definition, added spans on cases."""

from __future__ import annotations

import hashlib
import itertools
import operator
import random
import re
import time

from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystick.llm import pii, queries, secret_scan
from tallystick.llm.common import running
from tests.llm.frames import EDGES, documents


def slow_secrets(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.IGNORECASE | re.ASCII):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(a, b, ("assign", "access", "hex")[k]) for a, k, b in sorted(found)]


def slow_personal(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [(m.start(), 1, m.end())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits))
        found += [(m.start(), 2, m.end())] if 14 <= len(digits) <= 19 and total % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [(m.start(), 3, m.end())] if 10 <= sum(c.isdigit() for c in m[0]) <= 15 else []
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()


SECRETS = [
    'token = "abcdefgh12"', "TOKEN:token:abcdefghij", "api_key=x apikey : 'AbCdEf+/=_.-9'", "password=short passwd=longenough",
    "AKIAABCDEFGHIJKL AKIAABC AKIAAKIAABCDEFGHIJ", "0123456789abcdef" * 2 + " " + "f" * 31, "é\U0001f600 secret='" + "0123456789abcdef" * 3 + "'",
    "key dGhpcyBpcyBhIHNlY3JldA9zQ7LmXw2 end", "secretK=abcdefgh", "", "token==" * 400,
]


def test_secret_base_spans(spark):
    frame = documents(spark, EDGES + [(100 + i, t, "en", "a") for i, t in enumerate(SECRETS)])
    model = secret_scan.train(frame)
    rows = secret_scan.scan(frame, model).select("doc_id", secret_scan.listed("base").alias("base"), secret_scan.listed("found").alias("found"))
    want = {i: ",".join(f"{k}:{a}:{b}" for a, b, k in slow_secrets(t or "")) for i, t, _, _ in EDGES + [(100 + i, t, 0, 0) for i, t in enumerate(SECRETS)]}
    rows = rows.collect()
    assert len(rows) == frame.count()
    for row in rows:
        assert row["base"] == want[row["doc_id"]]
        assert set(filter(None, row["base"].split(","))) <= set(row["found"].split(","))


def test_running_totals(spark):
    draw = random.Random(2)
    arrays = [[draw.randrange(50) for _ in range(n)] for n in (0, 1, 2, 3, 4, 7, 8, 9, 40)]
    frame = spark.createDataFrame([(a,) for a in arrays], "a array<int>")
    for combine, plain in ((lambda x, y: x + y, operator.add), (F.greatest, max)):
        found = frame.select("a", running(F.col("a"), combine, 4).alias("r")).collect()
        assert all(r["r"] == list(itertools.accumulate(r["a"], plain)) for r in found) and len(found) == len(arrays)


def test_added_secrets_like_a_plain_reading(spark):
    """The ratio and the overlap rule, from the model's own table, token by token."""
    draw = random.Random(4)
    token = lambda: "".join(draw.choice("aeinrst09XqZ7_=") for _ in range(draw.randrange(15, 30)))
    glued = ["", " ", " ", "\n", ".", " token=", " AKIA", "é"]
    texts = ["".join(draw.choice(glued) + token() for _ in range(draw.randrange(1, 12))) for _ in range(60)]
    texts += ["x" * 25 + " " + "ab12" * 9, "secret=" + "q" * 40, "0123456789abcdef" * 3 + " " + "Zq9X" * 6]
    size = len(secret_scan.ALPHABET)
    model = [draw.uniform(-1, 2.2) for _ in range(size * size)]
    table = [float(f"{x:.6f}") for x in model]
    frame = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    found = secret_scan.scan(frame, model).select("doc_id", secret_scan.listed("found").alias("f")).collect()
    added = 0
    for row in found:
        text = texts[row["doc_id"]]
        base = slow_secrets(text)
        spans = [(a, ("assign", "access", "hex").index(k), b, k) for a, b, k in base]
        for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
            places = [secret_scan.ALPHABET.index(c) for c in m[0]]
            mean = sum(table[a * size + b] for a, b in zip(places, places[1:])) / len(m[0])
            if len(m[0]) >= 20 and mean >= secret_scan.PER_CHAR and all(m.end() <= a or b <= m.start() for a, b, _ in base):
                spans.append((m.start(), 3, m.end(), "random"))
                added += 1
        assert row["f"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    assert added > 20


def _seconds(spark, text, work):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    work(frame).collect()
    return time.perf_counter() - began


def test_secret_time_is_in_proportion_to_a_text(spark):
    draw = random.Random(1)
    model = [1.0] * len(secret_scan.ALPHABET) ** 2
    part = lambda n: " ".join(f"{draw.getrandbits(160):040x}" if i % 2 else "Q" * 24 for i in range(n))
    few, many = part(2000), part(20_000)
    _seconds(spark, few, lambda d: secret_scan.scan(d, model))
    assert _seconds(spark, many, lambda d: secret_scan.scan(d, model)) < 15 * max(_seconds(spark, few, lambda d: secret_scan.scan(d, model)), 1)


def test_personal_time_is_in_proportion_to_a_text():
    weights = pii.fit([pii._example(e) for e in pii.EXAMPLES])
    seconds = []
    for n in (2000, 20_000):
        text = " word ".join(f"a{i}@mail.example.com or 10.0.{i % 250}.7" for i in range(n))
        began = time.perf_counter()
        base, _ = pii.find(text, weights)
        seconds.append(time.perf_counter() - began)
        assert len(base) == 2 * n
    assert seconds[1] < 15 * max(seconds[0], 1)


def test_sample_is_bounded_whatever_the_ids(spark):
    """NULL and repeated ids do not fill the sample: what is learned stays as small."""
    rows = [(None if i % 2 else 7, f"mail u{i}@mail.example.com, k9QzX7mW2pLr4TbN8vYc{i:05d} end", "en", "a") for i in range(1500)]
    frame = documents(spark, rows + [(7, "mail one@mail.example.com", "en", "a")] * 1500)
    seen = []
    kept = pii.fit
    try:
        pii.fit = lambda labelled: seen.append(len(labelled)) or kept(labelled)
        pii.train(frame, sample_docs=100, sample_zones=100_000)
    finally:
        pii.fit = kept
    assert 2 * len(pii.EXAMPLES) < seen[0] < 2 * len(pii.EXAMPLES) + 200
    assert len(secret_scan.train(frame, 100)) == len(secret_scan.ALPHABET) ** 2


def test_random_token_is_added_and_words_are_not(spark, star_folder):
    given_documents = spark.read.parquet(f"{star_folder}/documents.parquet")
    model = secret_scan.train(given_documents)
    rows = documents(spark, [(1, "key dGhpcyBpcyBhIHNlY3JldA9zQ7LmXw2 end", "en", "a"), (2, "thanbleshaningtionntthering erberbeeinheitkeiterungen", "de", "a")])
    found = {r["doc_id"]: r["found"] for r in secret_scan.scan(rows, model).select("doc_id", secret_scan.listed("found").alias("found")).collect()}
    assert found == {1: "random:4:35", 2: ""}


def test_secrets_of_no_rows(spark):
    empty = documents(spark, [])
    assert secret_scan.scan(empty, secret_scan.train(empty)).collect() == []


def test_secret_query(spark, star_folder):
    texts = dict(spark.read.parquet(f"{star_folder}/documents.parquet").select("doc_id", "text").collect())
    frame = queries.op7_secret_scan(spark, star_folder)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    for row in frame.collect():
        spans = slow_secrets(texts[row["doc_id"]])
        assert row["base_sha256"] == digest(spans)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(sum(s[2] == k for s in spans) for k in ("assign", "access", "hex"))


@settings(max_examples=300, deadline=None)
@given(st.text("a.@+-1 2(3)0é_%\n", max_size=40))
@example("1.2.3.4.5.6.7.8")
@example("a@b.c@d.e f@g")
@example("x" * 50 + "@" + "a.b" * 20)
@example("4111 1111 1111 1111 +1 (202) 555-0143 4111-1111-1111-1111")
@example("0000000000000000000000000")
def test_personal_base_spans(text):
    assert pii.base_spans(text) == slow_personal(text)


def test_patterns_are_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "+1" * 100_000, "1." * 100_000, "@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)
        assert sum(b - a for a, b in pii.zones(text)) <= len(text)


def test_marginals_agree_with_enumeration():
    import itertools

    import numpy as np

    zone = pii.Zone("1 22.3@a")
    start, stop = zone.spans(0, zone.size)
    scores = np.random.default_rng(0).normal(size=(len(start), len(pii.KINDS)))
    choices = [(i, k) for i in range(len(start)) for k in range(len(pii.KINDS))]
    few = pii._marginals(zone.size, start, stop, scores - 12)  # three or more entities weigh next to nothing
    total, mass = 0.0, np.zeros_like(scores)
    for n in range(3):
        for picked in itertools.combinations(choices, n):
            spans = sorted((start[i], stop[i]) for i, _ in picked)
            if all(a[1] <= b[0] for a, b in itertools.pairwise(spans)):
                weight = np.exp(sum(scores[i, k] - 12 for i, k in picked))
                total += weight
                for i, k in picked:
                    mass[i, k] += weight
    assert np.allclose(few, mass / total, rtol=1e-6)


def test_field_finds_entities_by_itself():
    weights = pii.fit([pii._example(e) for e in pii.EXAMPLES] * 6)
    decoded = {(t[a:b], k) for t in ("call +1 (202) 555-0199 now", "a.b@c.example.net", "4111 1111 1111 1111", "192.0.2.9") for a, b, k, _ in pii.decode(t, weights)}
    assert decoded == {("+1 (202) 555-0199", "phone"), ("a.b@c.example.net", "email"), ("4111 1111 1111 1111", "card"), ("192.0.2.9", "ip")}
    assert not pii.decode("2024-05-17 10:22:31 9f86d081884c7d659a2feaa0c55ad015", weights)
    assert not pii.decode("1234567890123456", weights)


def test_personal_query(spark, star_folder):
    texts = dict(spark.read.parquet(f"{star_folder}/documents.parquet").select("doc_id", "text").collect())
    for row in queries.op9_personal_data(spark, star_folder).collect():
        spans = slow_personal(texts[row["doc_id"]])
        assert row["base_sha256"] == digest(spans)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in spans) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for a, b, k in spans} <= set(row["spans"].split(",")) | {""}


def test_long_runs_of_zeros(spark):
    zeros = "0" * 5000
    texts = [zeros, f"{zeros}.0.{zeros}7.1", f"mail a.b@c.example.net {zeros}"]
    frame = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    found = frame.select("doc_id", pii.spans(F.col("text"), pii.train(frame)).alias("s")).select("doc_id", "s.base").collect()
    base = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["base"]] for r in found}
    assert base == {0: [], 1: [("ip", 0, len(texts[1]))], 2: [("email", 5, 22)]}


def test_personal_data_of_awkward_rows(spark):
    frame = documents(spark, [*EDGES, (50, "mail a.b@c.example.net or +12025550143 now", "en", "a")])
    weights = pii.train(frame)
    redacted = {r["doc_id"]: r["t"] for r in frame.select("doc_id", pii.redacted(F.col("text"), weights).alias("t")).collect()}
    assert redacted[50] == "mail <email> or <phone> now"
    assert redacted[3] is None and redacted[4] == "" and redacted[7] == "word " * 30_000
    spans = frame.select("doc_id", pii.spans(F.col("text"), weights).alias("s")).collect()
    assert len(spans) == frame.count() and all(r["s"]["base"] == [] for r in spans if r["doc_id"] != 50)
    empty = documents(spark, [])
    assert empty.select(pii.spans(F.col("text"), pii.train(empty))).collect() == []
