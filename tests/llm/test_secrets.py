import hashlib
import itertools
import random
import re
import time
from collections import defaultdict

import pytest
from leafgrid.llm import secrets
from leafgrid.llm.common import running_sums
from pyspark.sql import functions as F

KEY = "9f8e7d6c5b4a39281706f5e4d3c2b1a0ffeeddcc"
SHARED = "00112233445566778899aabbccddeeff00112233"
AWS = "AKIA" + "ABCDEFGH12345678"
TEXTS = [
    (1, f'é x token = "{KEY}" y', "a"), (2, f"secret: {SHARED}", "a"), (3, f"Secret:{SHARED} PASSWD='short' api-key", "b"), (4, f"{AWS} AKIA12 {AWS}Z9", None),
    (5, "secret=password:abcdefgh1 token: token=abcdefghij", "c"), (6, None, "c"), (7, "", "c"), (8, "\U0001f600 api_key:abc.def=GHI+/-_ tail", "d"), (9, "a" * 31 + " " + "b" * 32, "d"),
    (10, f"token={KEY}{KEY} {'deadbeef' * 5}", "e"), (None, f"password => no; password=hunter2hunter2 {SHARED}", "f"), (1, f'é x token = "{KEY}" y', "a"), (11, "token=" * 3000, "g"),
]


def brute(texts):
    base, values = [], []
    for _, t, _ in texts:
        t = t or ""
        out = []
        assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
        own = set()
        for m in assign.finditer(t):
            if len(m[1]) >= 8:
                out.append((m.start(), 0, m.end()))
                own.add((m.start(1), m.end(), m[1]))
        out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        own |= {(m.start(), m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t)}
        base.append(sorted(out))
        values.append({v for v in own if re.search("[0-9]", v[2]) and re.search("[A-Za-z]", v[2]) and len(set(v[2])) >= 8})
    owners, repositories = defaultdict(set), defaultdict(set)
    for (d, _, o), vs in zip(texts, values):
        for _, _, v in vs:
            owners[v].add(o)
            repositories[v].add((o, d))
    show = lambda s: ",".join(f"{secrets.KINDS[k]}:{a}:{e}" for a, k, e in s)
    rows = []
    for (d, _, _), b, vs in zip(texts, base, values):
        live = [(a, 3, e) for a, e, v in vs if len(owners[v]) <= 1 and len(repositories[v]) <= 5]
        n = [sum(k == j for _, k, _ in b) for j in range(3)]
        rows.append((d, *n, hashlib.sha256(show(b).encode()).hexdigest(), show(sorted(b + live)), len(live), len(vs) - len(live)))
    return sorted(rows, key=str)


def test_scan_matches_brute_force(documents):
    got = secrets.scan(documents([(d, t, "en", s) for d, t, s in TEXTS])).collect()
    assert sorted(map(tuple, got), key=str) == brute(TEXTS)


def test_owner_tells_copied_from_live(documents):
    got = {r["doc_id"]: r for r in secrets.scan(documents([(d, t, "en", s) for d, t, s in TEXTS])).collect()}
    assert "live" in got[1]["spans"] and got[1]["n_copied"] == 0
    assert "live" not in got[2]["spans"] and got[2]["n_copied"] == 1


def test_hot_value(documents):
    rows = [(k, f"token={SHARED}", "en", f"s{k % 5}") for k in range(500)] + [(900, f"token={KEY}", "en", "s1")]
    got = secrets.scan(documents(rows))
    assert got.count() == 501 and got.where("n_live > 0").count() == 1


def test_one_owner_with_many_repositories_is_copied(documents):
    rows = [(k, f"token: {SHARED}", "en", "s") for k in range(6)] + [(10 + k, f"token: {KEY}", "en", "s") for k in range(5)]
    rows += [(20, f"token: {KEY}", "en", "s"), (20, f"token: {KEY[::-1]}", "en", "s"), (20, f"token: {KEY[::-1]}", "en", "s")]
    got = sorted((r["doc_id"], r["n_live"], r["n_copied"]) for r in secrets.scan(documents(rows)).collect())
    assert [(r[0] < 20, r[1], r[2]) for r in got if r[0] < 10] == [(True, 0, 1)] * 6
    assert all((r[1], r[2]) == (0, 1) for r in got if 10 <= r[0] < 15)
    assert [r[1:] for r in got if r[0] == 20] == [(0, 1), (1, 0), (1, 0)]


def test_many_matches_in_one_text_take_linear_time(documents):
    rng = random.Random(4)
    t = " ".join("".join(rng.choices("0123456789abcdef", k=32)) for _ in range(30_000))
    began = time.monotonic()
    got = secrets.scan(documents([(1, t, "en", "a")])).collect()
    assert got[0]["n_hex"] == got[0]["n_live"] == 30_000 and time.monotonic() - began < 60
    assert sorted(map(tuple, got), key=str) == brute([(1, t, "a")])


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, n):
    x = list(range(n))
    got = spark.createDataFrame([(x,)], "x array<bigint>").select(running_sums(F.col("x"), 16).alias("s")).first()[0]
    assert got == list(itertools.accumulate(x))


def test_empty_table(documents):
    assert secrets.scan(documents([])).collect() == []
