"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
import check
from brisa.llm import turns

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """Nodes of rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        sha = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
        own[c].append(((turn is not None, turn or 0, sha), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0][:2])] for c, x in own.items()}
    made = {}
    for c, t in own.items():
        if c is None:
            made[c] = t
            continue
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    rank = lambda c: (c is None, c or 0)
    first = {n: min(m, key=rank) for n, m in members.items()}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if c is not None and len(made[c]) == len(n)))
        sha = hashlib.sha256(ends.encode()).hexdigest()
        up = first[n[:-1]] if n else None
        out.append((first[n], len(n), up, len(m), children[n], leaves[n], saved[n], sha))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def found(df):
    return sorted((tuple(r[c] for c in NAMES) for r in turns.prefix_trie(df).collect()), key=repr)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sql(spark, sf, sf_dir):
    verdict, detail, _ = check.compare(spark, check.oracle_connection(sf_dir), "op12_prefix_trie", sf_dir)
    assert verdict == "ok", detail
    assert set(entry.queries()["op12_prefix_trie"](spark, sf_dir).columns) == set(NAMES)


@pytest.mark.parametrize("cells", [1, 4_096])
def test_made_conversations(spark, sf, monkeypatch, cells):
    """Long, shared, missing and turnless ones; every running figure also cut into cells."""
    monkeypatch.setattr(turns, "CELL", cells * 2)
    monkeypatch.setattr(turns, "SPAN", cells * 8)
    rng = random.Random(cells)
    rows = []
    for c in rng.sample([c for c in range(200) if c != 5], 110):
        many = rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 30])
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["a", "é", "long text"]) * (t % 3)) for t in range(many)]
    rows += [(5, t, "user", f"turn {t}") for t in range(60)]
    assert found(table(spark, rows).repartition(7)) == plain(rows)


def test_odd_rows(spark, sf):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "", ""), (1, 2, "user", "x" * 50_000),
        (None, 0, "user", "no id"), (None, 1, "user", "nor this"),
        (7, 3, "user", "only"), (-4, 0, "user", "below"), (12, 0, "u", "sera"), (12, 1, "us", "era"),
    ]
    assert found(table(spark, rows)) == plain(rows)
    twice = [(20, 0, "a", "same")] * 3 + [(25, 0, "a", "same")]
    assert found(table(spark, twice)) == plain(twice)
    extra = table(spark, rows).selectExpr("*", "1 AS block", "2 AS level", "'x' AS t0", "3 AS depth", "4 AS pos")
    assert found(extra) == plain(rows)
    assert found(table(spark, [])) == []


def test_plans_stay_small(spark, sf, monkeypatch):
    """The driver holds the plan of what runs: no step has more than a few shuffles."""
    shuffles = {}

    def count(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    def counted(df, name, stored=turns.stored):
        shuffles[name] = count(df)
        return stored(df, name)

    monkeypatch.setattr(turns, "stored", counted)
    out = turns.prefix_trie(spark.read.parquet(f"{sf}/conversations.parquet"))
    assert max(*shuffles.values(), count(out)) <= 8 and max(shuffles.values()) >= 2


def test_digests_when_joins_are_replanned(spark, sf, monkeypatch):
    """A node's lists of ends stay in one task, whatever becomes of joins as they run."""
    monkeypatch.setattr(turns, "SPAN", 8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "128k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    members = defaultdict(list)
    for c in range(100_000):
        members[c % 35 if c % 5 == 0 else 0].append(str(c))
    ends = spark.range(100_000).selectExpr("id AS conv_id", "if(id % 5 = 0, id % 35, 0) AS ka", "0L AS kb")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.ka: r.ends_sha256 for r in turns._digests(ends).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k: hashlib.sha256(",".join(m).encode()).hexdigest() for k, m in members.items()}
