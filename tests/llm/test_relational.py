"""Splits, samples, survivors, clusters and mixes against hand-made and brute-force results."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusloom import runtime
from corpusloom.llm import consolidate, mixing, quota_sample, splits, stable_sample, survivors
from corpusloom.llm.tokenizer import public_tokens, white_space_tokens

T0 = dt.datetime(2026, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    found = defaultdict(set)
    for x in parent:
        found[root(x)].add(x)
    return {frozenset(v) for v in found.values()}


def as_sets(rows, vertex, name):
    found = defaultdict(set)
    for r in rows:
        found[r[name]].add(r[vertex])
    return {frozenset(v) for v in found.values()}


SHAPES = {
    "chain": [(f"{i:03d}", f"{i + 1:03d}") for i in range(70)],
    "star": [("149", f"{i:03d}") for i in range(90)],
    "low star": [("000", f"{i:03d}") for i in range(1, 90)],
    "ring": [(f"{i:03d}", f"{(i + 1) % 40:03d}") for i in range(40)],
    "pairs": [(f"{2 * i:03d}", f"{2 * i + 1:03d}") for i in range(50)],
    "complete": [(f"{i:03d}", f"{j:03d}") for i in range(14) for j in range(i)],
}


def test_components_of_any_shape(spark, monkeypatch):
    """All shapes in one graph, under shuffled names; the edges of all hubs are dealt out."""
    monkeypatch.setattr(runtime, "HOT_ROWS", 0)
    rng = random.Random(5)
    edges = []
    for shape, own in {**SHAPES, "random": [(f"{rng.randrange(150):03d}", f"{rng.randrange(150):03d}") for _ in range(110)]}.items():
        names = [f"{i:03d}" for i in range(150)]
        if shape != "low star":
            rng.shuffle(names)
        edges += [(f"{shape}{names[int(a)]}", f"{shape}{names[int(b)]}") for a, b in own if a != b]
    df = spark.createDataFrame([(min(e), max(e)) for e in edges], "a string, b string").distinct()
    by_min, want = consolidate.hash_to_min(df).collect(), components(edges)
    assert as_sets(by_min, "v", "root") == want
    assert all(r.root == min(s) for r in by_min for s in want if r.v in s)
    assert as_sets(splits.frontier_components(df).collect(), "v", "component") == want


def test_components_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert consolidate.hash_to_min(df).count() == 0 == splits.frontier_components(df).count()


PAIRS = "id_a string, id_b string, estimated_similarity double, v int, m int"


def test_consolidate_ignores_what_is_no_link(spark):
    records = spark.createDataFrame([("A1", 1), ("a2 ", 2), ("A2", 2), ("a3", 3), ("a4", 4), ("a5", 5), (None, 6), ("", 7)], "record_id string, root int")
    rows = [
        ("a2", "A1\t", 0.8, 1, 1),
        (" a1", "a2", 0.1, 1, 1),
        ("a3", "a2", 1.0, 1, 1),
        ("a4", "a4", 1.0, 1, 1),
        ("a4", "a5", 0.79, 1, 1),
        ("a4", "a5", 1.01, 1, 1),
        ("a4", "a5", float("nan"), 1, 1),
        ("a4", "a5", None, 1, 1),
        ("a4", "zz", 0.9, 1, 1),
        (None, "a5", 0.9, 1, 1),
        ("", "a5", 0.9, 1, 1),
    ]
    found = consolidate.consolidate(spark.createDataFrame(rows, PAIRS), records).collect()
    assert {(r.record_id, r.cluster_id) for r in found} == {("a1", "a1"), ("a2", "a1"), ("a3", "a1")}
    none = spark.createDataFrame([], PAIRS)
    assert consolidate.consolidate(none, records).count() == 0
    assert consolidate.consolidate(none, records.limit(0)).count() == 0


REFS = "group_id string, source string, original_id string, split string, component int"


def test_splits_keep_works_together(spark):
    rows = [(f"g{i}", "s", f"w{i}", None, 1) for i in range(400)]
    rows += [("G0 ", "S", "W-5", None, 1), ("g5", "s", "w 6", None, 1), ("g7", "s", None, None, 1), ("g8", None, "w9", None, 1), (None, "s", "w1", None, 1), ("g9", "s", "--", None, 1)]
    rows += [("hot", "s", "hot", None, 1)] * 200
    refs = spark.createDataFrame(rows, REFS)
    halves = (("test", 2000), ("validation", 2000), ("train", 6000))
    out = splits.assign_splits(refs, halves).collect()
    assert len(out) == 401 and len({r.group_id for r in out}) == 401
    of = {r.group_id: r for r in out}
    assert of["g0"].component == of["g5"].component == of["g6"].component == "g0"
    assert of["g0"].split == of["g5"].split == of["g6"].split
    assert of["g9"].component == "g9" and of["g8"].component == "g8" and of["g1"].component == "g1"
    counts = defaultdict(int)
    for g, *_ in rows:
        if g:
            counts[of[g.strip().lower()].split] += 1
    assert counts["train"] > counts["test"] > 50
    shuffled = splits.assign_splits(refs.repartition(7, "original_id").orderBy(F.rand(3)), halves).collect()
    assert {tuple(r) for r in shuffled} == {tuple(r) for r in out}
    assert splits.assign_splits(refs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        splits.assign_splits(refs, (("train", 1),))


def test_torn_apart(spark):
    refs = spark.createDataFrame([("a", "s", "1", None, 1), ("b", "s", "1", None, 1), ("b", "s", "2", None, 1), ("c", "s", "2", None, 1), ("d", "t", "1", None, 1), ("e", "s", "1", None, 1)], REFS)
    rows = [("a", "train", day(1)), ("A", "test", day(0)), ("b", "Train ", day(1)), ("c", "TEST", day(1)), ("d", "test", day(1)), ("e", "test", day(1)), ("e", None, day(2)), ("x", "test", None)]
    groups = spark.createDataFrame(rows, "group_id string, split string, assigned_at timestamp")
    assert {tuple(r) for r in splits.torn_apart(refs, groups).collect()} == {("a", "c"), ("b", "c")}
    assert splits.torn_apart(refs, groups.limit(0)).count() == 0
    assert splits.torn_apart(refs.limit(0), groups).count() == 0
    many = spark.createDataFrame([(f"{i:04d}", "s", "w", None, 1) for i in range(700)], REFS)
    held = many.select("group_id", F.when(F.col("group_id") < "0003", "test").otherwise("train").alias("split"), F.lit(T0).alias("assigned_at"))
    pairs = splits.torn_apart(many, held).collect()
    assert len({tuple(r) for r in pairs}) == 3 * 697 == len(pairs)
    assert {r.group_id for r in splits.torn_members(refs, groups).collect()} == {"a", "b", "c"}


CAND = "doc_id string, rank_hash string, batch_no int, seen_at timestamp, normalized_words long, sample_bucket string, words long, need long"


def candidates(n, words=lambda i: 1 + i % 7, bucket=lambda i: "a/b" if i % 3 else "c"):
    return [(f"{i:06x}", None, 1 + i % 3, day(i % 5), words(i), bucket(i), 0, 0) for i in range(n)]


def test_stable_sample_grows_only(spark):
    rows = candidates(2000)
    want = {r[0] for r in rows if int(hashlib.sha256(b"sample-v1\0" + r[0].encode()).hexdigest(), 16) < 2**256 // 25}
    old = {r.doc_id for r in stable_sample.stable_sample(spark.createDataFrame(rows[:1500], CAND)).collect()}
    dirty = [(" " + r[0].upper() + "\t", "wrong", None, None, None, None, 0, 0) for r in rows[::2]] + [(None, *r[1:]) for r in rows[:3]] + [("- ", *r[1:]) for r in rows[:3]]
    new = stable_sample.stable_sample(spark.createDataFrame(rows + dirty, CAND).repartition(5)).collect()
    assert {r.doc_id for r in new} == want and len(new) == len(want)
    assert old == {d for d in want if int(d, 16) < 1500}
    assert all(r.first_batch in (1, 2, 3) and r.deliveries in (1, 2) for r in new)
    assert stable_sample.stable_sample(spark.createDataFrame([], CAND)).count() == 0
    assert stable_sample.threshold(Fraction(0)) == "0" * 64
    everything = stable_sample.stable_sample(spark.createDataFrame(rows, CAND).select("doc_id"), Fraction(1))
    assert everything.count() == 2000


PLAN = "sample_bucket string, target_words long, min_words long, words long"


def test_quota_sample(spark):
    rows = candidates(3000)
    rows += [(r[0], None, 9, day(9), None, "a/b", 0, 0) for r in rows[:30]]  # current rows without words
    rows += [("ffff01", None, 1, day(1), 10, None, 0, 0), ("ffff02", None, 1, day(1), 10, "other", 0, 0), ("ffff03", None, 1, None, -5, "c", 0, 0), (None, None, 1, day(1), 5, "c", 0, 0)]
    plan = spark.createDataFrame([("a/b", 900, 100, 0), (" C ", 400, 100, 0), ("tiny", 50, 50, 0), (None, 5, 5, 0), ("floor", None, None, 0)], PLAN)
    sample, report = quota_sample.sample_to_quota(spark.createDataFrame(rows, CAND), plan)
    rep = {r.sample_bucket: r for r in report.collect()}
    assert set(rep) == {"a/b", "C", "tiny", "floor"}
    have = {"a/b": sum(r[4] for i, r in enumerate(rows[30:3000], 30) if i % 3), "C": sum(r[4] for i, r in enumerate(rows[30:3000], 30) if not i % 3)}
    assert {b: rep[b].available_words for b in have} == have
    assert 900 <= rep["a/b"].sampled_words < 907 and 400 <= rep["C"].sampled_words < 407
    assert rep["a/b"].target_met and rep["C"].floor_met and not rep["tiny"].target_met and rep["tiny"].available_docs == 0 and rep["floor"].target_met
    drawn = sample.collect()
    assert len({r.doc_id for r in drawn}) == len(drawn)
    assert sum(r.drawn == "systematic" for r in drawn) > 0.7 * len(drawn)
    again = quota_sample.sample_to_quota(spark.createDataFrame(rows[::-1], CAND).repartition(3), plan)[0]
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in drawn}
    short = quota_sample.sample_to_quota(spark.createDataFrame(candidates(20), CAND), plan)[1]
    assert all(r.sampled_words == r.available_words for r in short.collect() if r.sample_bucket != "floor")
    none, empty = quota_sample.sample_to_quota(spark.createDataFrame([], CAND), plan)
    assert none.count() == 0 and empty.count() == 4
    assert quota_sample.sample_to_quota(spark.createDataFrame(rows, CAND), plan.limit(0))[1].count() == 0


RECORD = (
    "record_id string, content_sha256 string, source string, subset string, subset_tier int, title string, original_id string, original_url string, license string, "
    "publication_date string, source_revision string, updated_at timestamp, loaded_at timestamp, tier int, copies int, turned string"
)


def record(i, content, source="s", tier=None, title=None, oid=None, url=None, lic=None, date=None, rev=None, updated=None, loaded=0):
    return (i, content, source, "u", tier, title, oid, url, lic, date, rev, updated, None if loaded is None else day(loaded), 9, 9, "x")


TIERS = "source string, subset string, tier int"


def test_representatives(spark):
    rows = [
        record("B1", "AA", tier=1, title="x"), record("b2", "aa ", tier=1, title="x", oid="o"), record("b3", "aa", tier=1, title="x", oid="None "),
        record("c1", "cc", source="known", tier=99), record("c2", "cc", source="other", tier=None, title="x", oid="x"), record("c3", "cc", source="Known", tier=-1),
        record("d1", "dd", tier=2, updated=None), record("d2", "dd", tier=2, updated=day(3)), record("d3", "dd", tier=2, updated=day(3)),
        record("e1", "ee", tier=0, loaded=0), record("e1", "ff", tier=0, loaded=1), record("e2", "ff", tier=1), record("e3", "ee", tier=1, loaded=None),
        record("f1", None), record("f2", None), record("g1", ""), record(None, "aa", tier=0),
    ]
    tiers = spark.createDataFrame([("KNOWN", "U", 3), (None, "u", 0), ("known", "u", None)], TIERS)
    df = spark.createDataFrame(rows, RECORD)
    got = {r.content_sha256: r for r in survivors.survivors(df, tiers).collect()}
    assert {k: r.representative_record_id for k, r in got.items()} == {"aa": "b2", "cc": "c1", "dd": "d2", "ff": "e1"}
    assert {k: r.copies for k, r in got.items()} == {"aa": 3, "cc": 3, "dd": 3, "ff": 2}
    state = {r.record_id: (r.representative_record_id, r.disposition) for r in survivors.dispositions(df, tiers).collect()}
    assert state["b1"] == ("b2", "dropped") and state["b2"] == ("b2", "retained") and state["f1"] == ("f1", "retained") and state["e3"] == ("e3", "retained") and len(state) == 15
    assert survivors.survivors(df.limit(0), tiers).count() == 0
    assert survivors.survivors(df, tiers.limit(0)).count() == 4


def test_bundles_are_taken_whole(spark):
    rows = [
        record("a1", "aa", source="s", tier=0, oid="S-1", rev="r1"),
        record("a2", "aa", source="t", tier=1, oid="T-1", url="http://t", lic="by", title="T", date="2020", rev="r2"),
        record("a3", "aa", source="s", tier=4, oid="S-9", url="http://s9", lic="nc", rev="r9"),
    ]
    got = survivors.survivors(spark.createDataFrame(rows, RECORD), spark.createDataFrame([], TIERS)).first()
    assert (got.original_id, got.original_url) in {("S-1", None), ("T-1", "http://t"), ("S-9", "http://s9")}
    assert (got.title, got.publication_date) == ("T", "2020")
    # the licence comes from the source of the identity
    assert {"S-1": "nc", "T-1": "by", "S-9": "nc"}[got.original_id] == got.license
    assert len(got.bundle_records) == 4


def test_survivors_reach_the_optimum_of_any_bundles(spark):
    """All records against the search and its leaders; bundle names that look like inner columns, two separate tied sets."""
    from itertools import product

    shapes = [
        survivors.BUNDLES,
        survivors.Bundles((("d", ("title",)), ("s", ("license",)), ("__k", ("original_id",)), ("score", ("original_url",))), (("d", "s"), ("__k", "score"))),
        survivors.Bundles((("a", ("title",)), ("b", ("license",)), ("c", ("original_id",))), ((survivors.KEEPER, "b"), ("a", "b"), ("b", "c"), ("a", "c"))),
    ]
    rng = random.Random(8)
    rows = []
    for g in range(40):
        for i in range(rng.randint(2, 9)):
            full = [rng.choice([None, "x", f"v{rng.randrange(9)}"]) for _ in range(5)]
            rows.append(record(f"{g:02d}{i}", f"c{g:02d}", rng.choice("pqrst"), rng.randrange(6), *full, rev=rng.choice([None, "r"]), updated=rng.choice([None, day(rng.randrange(900))])))
    names = [part.split()[0] for part in RECORD.split(", ")]
    table = [dict(zip(names, r, strict=True)) for r in rows]
    for shape in shapes:
        got = {r.content_sha256: r for r in survivors.survivors(spark.createDataFrame(rows, RECORD), spark.createDataFrame([], TIERS), shape).collect()}
        for content in {r["content_sha256"] for r in table}:
            mine = [r for r in table if r["content_sha256"] == content]
            keep = min(mine, key=lambda r: (r["subset_tier"], -sum(bool(r[c]) for c in survivors.COMPLETE), -(r["updated_at"] or dt.datetime.min).toordinal(), r["record_id"]))

            def score(r, fields):
                full = sum(bool(r[f]) for f in fields)
                return full and (6 - r["subset_tier"]) * 10_000_000 + full * 1_000_000 + ((r["updated_at"] - dt.datetime(1970, 1, 1)).days if r["updated_at"] else 0)

            best = [{s: max(score(r, f) for r in mine if r["source"] == s) for s in {r["source"] for r in mine}} | {None: 0} for _, f in shape.fields]
            at = {n: i for i, n in enumerate(shape.names)}
            most = 0
            for pick in product(*best):
                of = {n: pick[i] for n, i in at.items()} | {survivors.KEEPER: keep["source"]}
                if all(of[a] is None or of[b] is None or of[a] == of[b] for a, b in shape.same_source):
                    most = max(most, sum(b[p] for b, p in zip(best, pick, strict=True)))
            assert (got[content].representative_record_id, got[content].trust) == (keep["record_id"], most)


def test_branch_and_bound_equals_enumeration():
    rng = random.Random(2)
    from itertools import product

    for _ in range(300):
        n = rng.randint(1, 4)
        choices = [sorted([(rng.randint(1, 9), rng.choice("abc"), k) for k in range(rng.randint(0, 4))], key=lambda c: (-c[0], c[1], c[2])) + [(0, "", None)] for _ in range(n)]
        same = [(i, j) for i in range(n) for j in range(i) if rng.random() < 0.6]
        best = max(
            sum(c[0] for c in pick) for pick in product(*choices) if all(not pick[i][1] or not pick[j][1] or pick[i][1] == pick[j][1] for i, j in same)
        )
        total, pick = survivors.branch_and_bound(choices, same)
        assert total == best == sum(choices[i][k][0] for i, k in enumerate(pick))


DOCS = "doc_id long, text string, source string, subset string, tokens long, component string, key string"
MIX = "component string, share_bp int, max_repeats int, budget_tokens long, key string"


def test_schedule_stays_within_a_block():
    for weights in ({"a": 5000, "b": 3000, "c": 2000}, {"a": 1, "b": 9999}, {"a": 3, "b": 3, "c": 3}, {"a": 7, "b": 0}):
        total, given = sum(weights.values()), defaultdict(int)
        rows = mixing.earliest_deadlines(weights)
        assert [s for *_, s in rows] == list(range(total))
        for name, block, slot in rows:
            assert given[name] == block
            given[name] += 1
            assert all(abs(given[n] * total - w * (slot + 1)) < total for n, w in weights.items())
        assert {n: k for n, k in given.items() if k} == {n: w for n, w in weights.items() if w}


def within_a_block(used, weights, block):
    """Every slot holds one component's block; at each slot every component that still has blocks has had its share of the phase to less than one block."""
    slots = defaultdict(lambda: defaultdict(int))
    for u in used:
        slots[u.slot][u.component] += u.to_token - u.from_token
    assert sorted(slots) == list(range(len(slots))) and all(len(s) == 1 for s in slots.values())
    order = [next(iter(slots[i])) for i in range(len(slots))]
    last = {c: i for i, c in enumerate(order)}
    assert all(slots[i][c] == block for i, c in enumerate(order) if i != last[c]) and all(0 < slots[i][c] <= block for c, i in last.items())
    had, start = defaultdict(int), 0
    for i, c in enumerate(order):
        active = {c: weights[c] for c, end in last.items() if end >= start}
        had[c] += 1
        worst = max(abs(had[c] - w * (i + 1 - start) / sum(active.values())) for c, w in active.items())
        assert worst < 1
        if i in last.values():
            had, start = defaultdict(int), i + 1


def test_phases():
    for weights, blocks in [({"a": 5000, "b": 3000, "c": 2000}, {"a": 50, "b": 7, "c": 33}), ({"a": 1, "b": 9999}, {"a": 3, "b": 1}), ({"a": 3}, {}), ({"a": 2, "b": 1}, {"a": 0, "b": 30000})]:
        given, at = defaultdict(int), 0
        for p in mixing.phases(weights, blocks):
            assert p.first_slot == at and p.done == {n: given[n] for n in p.weights} and len(p.table) == min(p.slots, p.period)
            at += p.slots
            given |= p.upto
        assert {n: k for n, k in given.items() if k} == {n: k for n, k in blocks.items() if k} and at == sum(blocks.values())
    with pytest.raises(ValueError):
        mixing.phases({"a": 0}, {"a": 1})


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(1, 60)), rng.choice(["Big ", "p_q", "p-q"]), rng.choice(["One", "one", "two"]), 1, "x", "k") for i in range(400)]
    rows += [(899, "w " * 5000, "p_q", "ONE", 1, "x", "k"), (900, None, "big", None, 1, "x", "k"), (901, "", "big", None, 1, "x", "k"), (902, "w w", None, None, 1, "x", "k"), (903, "w w", "none such", None, 1, "x", "k"), (904, "é" * 40000, "big", None, 1, "x", "k")]
    plan = [("big", 4000, 1, 9000, "k"), ("p_q/one", 3000, None, 9000, "k"), ("p_q/two", 2900, 4, 9000, "k"), ("absent", 100, 2, 9000, "k"), (None, 50, 1, 9000, "k")]
    docs, table = spark.createDataFrame(rows, DOCS), spark.createDataFrame(plan, MIX)
    mixed, report = mixing.mix(docs, table, white_space_tokens, block_tokens=64)
    used, rep = mixed.collect(), {r.component: r for r in report.collect()}
    assert set(rep) == {"big", "p_q/one", "p_q/two", "absent"}
    assert rep["absent"].mixed_tokens == 0 and not rep["absent"].target_met
    for name, r in rep.items():
        own = [u for u in used if u.component == name]
        assert sum(u.to_token - u.from_token for u in own) == r.mixed_tokens and len({(u.doc_id, u.repeat_no) for u in own}) == r.mixed_uses
        assert r.mixed_tokens <= r.most_tokens and r.mixed_tokens < r.target_tokens + (5000 if name == "p_q/one" else 61)
        assert r.target_met == (r.most_tokens >= r.target_tokens)
        at = 0
        for u in sorted(own, key=lambda u: u.component_offset):
            assert u.component_offset == at and u.slot >= 0
            at += u.to_token - u.from_token
        for use in {(u.doc_id, u.repeat_no, u.tokens) for u in own}:
            spans = sorted((u.from_token, u.to_token) for u in own if (u.doc_id, u.repeat_no, u.tokens) == use)
            assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]] and spans[-1][1] == use[2]
    within_a_block(used, {c: bp for c, bp, *_ in plan if c}, 64)
    assert max(u.repeat_no for u in used if u.component == "p_q/two") <= 4
    assert {u.doc_id for u in used}.isdisjoint({900, 901, 902, 903})
    again = mixing.mix(docs.repartition(5), table, white_space_tokens, block_tokens=64)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, used))
    none = mixing.mix(docs.limit(0), table, white_space_tokens)
    assert none[0].count() == 0 and none[1].count() == 4
    assert mixing.mix(docs, table.limit(0), white_space_tokens)[1].count() == 0


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_public_tokens(spark, vocabulary):
    df = spark.createDataFrame([("olá mundo",), ("",), (None,), ("<|endoftext|>",), ("a" * 50000,)], "text string")
    counts = [r[0] for r in df.select(public_tokens("text", vocabulary)).collect()]
    assert counts[1] == counts[2] == 0 and 1 < counts[0] < 9 and counts[3] > 1 and counts[4] > 100


def test_two_files_of_one_vocabulary_agree(spark):
    df = spark.createDataFrame([("O Sr. João não viu 1.234 casas\r\n\n  de pé!  ",), ("it's çé  — ok\t\n",)], "text string")
    a, b = public_tokens("text", "byte_bpe_50k.tiktoken"), public_tokens("text", "byte_bpe_50k.json")
    assert all(r[0] == r[1] for r in df.select(a, b).collect())
