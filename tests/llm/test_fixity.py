"""Merkle audit against direct comparison and a hand-built tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from meteoframe.llm import fixity

S = fixity.Settings(fan=3, ranges=11)
COLS = "page_id long, url string, html string, hash string"


def record(url, html):
    body = (html or "").encode()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\n"
    return head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def brute(rows):
    """(leaves in order, root) of one replica."""
    made = sorted(((p is not None, p or 0, hashlib.sha256(record(u, h)).hexdigest(), len(record(u, h)))
                   for p, u, h, _ in rows))
    at, leaves = 0, []
    for _, _, digest, size in made:
        leaves.append((at, at + size, digest))
        at += size
    level = leaves
    while len(level) > 1:
        level = [(g[0][0], g[-1][1], hashlib.sha256(
            f"{g[0][0]}|{g[-1][1]}|{''.join(n[2] for n in g)}".encode()).hexdigest())
            for g in (level[i:i + S.fan] for i in range(0, len(level), S.fan))]
    return leaves, level[0][2] if level else None


ROWS = [(i * 7 - 20, f"http://x/{i}", f"<p>body é {i}</p>" * (i % 5), "z") for i in range(40)]
ROWS += [(5, None, None, "z"), (5, "", "", "z"), (5, "", "", None), (None, "u", "nobody", "z"), (9, "long", "x" * 300_000, "z")]


@pytest.mark.parametrize("damage", [[], [0], [3, 17, 39], list(range(45))])
def test_locates_exactly_the_damage(spark, damage):
    other = [(p, u, (h or "") + "!" if i in damage else h, z) for i, (p, u, h, z) in enumerate(ROWS)]
    # the same length keeps the offsets of all others
    other = [(p, u, "?" + h[1:] if i in damage and ROWS[i][2] else (ROWS[i][2] if i in damage else h), z)
             for i, (p, u, h, z) in enumerate(other)]
    want = {(p, u, h2) for (p, u, h, _), (_, _, h2, _) in zip(ROWS, other) if h != h2}
    got = fixity.audit_replica(spark.createDataFrame(ROWS, COLS), spark.createDataFrame(other, COLS), S).collect()
    leaves, root = brute(ROWS)
    leaves2, root2 = brute(other)
    got.sort(key=lambda r: r.ordinal)
    assert [(r.start, r.start + r.length, r.hash) for r in got] == leaves
    assert {r.root for r in got} == {root} and {r.replica_root for r in got} == {root2}
    assert [r.corrupt for r in got] == [a != b for a, b in zip(leaves, leaves2)]
    assert sum(r.corrupt for r in got) >= len(want)


def test_missing_record_and_empty(spark):
    df = spark.createDataFrame(ROWS, COLS)
    got = fixity.audit_replica(df, df.filter("page_id IS NULL OR page_id <> 9"), S).collect()
    at = next(r.ordinal for r in got if r.page_id == 9)
    assert all(r.corrupt == (r.ordinal >= at) for r in got)
    assert fixity.audit_replica(df.limit(0), df.limit(0), S).count() == 0
    assert all(r.corrupt for r in fixity.audit_replica(df, df.limit(0), S).collect())


def test_ranges_are_even_for_sparse_repeated_and_null_ids(spark):
    rng = random.Random(4)
    ids = [rng.getrandbits(63) - (1 << 62) for _ in range(800)] + [None] * 800 + [7] * 400
    df = spark.createDataFrame([(i, f"http://x/{k}", str(k)) for k, i in enumerate(ids)],
                               "page_id long, url string, html string").repartition(5)
    settings = fixity.Settings(ranges=8)
    rows = df.select("page_id", F.sha2("html", 256).alias("hash"))
    order = [F.col("page_id").asc_nulls_first(), F.col("hash")]
    sizes = [r["count"] for r in fixity.in_ranges(rows, order, settings).groupBy("range").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 2000 / 8 * 1.5
    got = sorted(fixity.leaves(df, settings).collect(), key=lambda r: r.ordinal)
    assert [r.ordinal for r in got] == list(range(2000))
    keys = [(r.page_id is not None, r.page_id or 0, r.hash) for r in got]
    assert keys == sorted(keys)
    assert all(a.start + a.length == b.start for a, b in zip(got, got[1:]))
