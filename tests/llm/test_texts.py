"""Near copies, leaks and languages against brute force and held-out samples."""

from __future__ import annotations

import datetime as dt
import random
import re
import unicodedata
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language, leakage, near_copies

T0 = dt.datetime(2026, 1, 1)
WORDS = [f"palavra{i}" for i in range(400)]
SAMPLES = Path("/root/testdata/sf0.001/lang_sample.parquet")


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, t, k):
    w = t.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


DOCS = "record_id string, text string, loaded_at timestamp, words int, digest string, class_id long, a long, b long"


def near_rows():
    rng = random.Random(9)
    rows = []
    for i in range(60):
        base = text(rng, rng.randint(25, 200))
        for k in range(4):
            rows.append((f"{i:02x}{k}", edited(rng, base, k * 2), T0))
    rows += [(f"copy{i}", rows[0][1].upper() if i % 2 else rows[0][1] + "!", T0) for i in range(30)]
    rows += [("late", "x y", T0), ("Late ", rows[4][1], T0 + dt.timedelta(1)), ("gone", rows[4][1], T0), ("GONE", None, T0 + dt.timedelta(1)), ("undated", rows[8][1], None)]
    rows += [("short", text(rng, 19), T0), ("none", None, T0), ("empty", "", T0), (None, rows[0][1], T0), ("", rows[0][1], T0), ("long", text(rng, 60000), T0)]
    return [(*r, 1, "x", 2, 3, 4) for r in rows]


def brute(rows, like):
    newest = {}
    for r in rows:
        key = re.sub("[^0-9a-z]", "", (r[0] or "").lower())
        if key and (key not in newest or (r[2] or dt.datetime.min) >= (newest[key][1] or dt.datetime.min)):
            newest[key] = (r[1], r[2])
    sets = {}
    for key, (t, _) in newest.items():
        w = re.findall(r"[^\W_]+", unicodedata.normalize("NFC", t or "").lower())
        if len(w) >= like.least_words:
            sets[key] = {tuple(w[i : i + like.words]) for i in range(len(w) - like.words + 1)}
    out = {}
    for a in sets:
        for b in sets:
            if a < b and (n := len(sets[a] & sets[b])) and n * like.least.denominator >= like.least.numerator * (len(sets[a]) + len(sets[b]) - n):
                out[a, b] = n / (len(sets[a]) + len(sets[b]) - n)
    return out, set(sets)


@pytest.mark.parametrize("like", [near_copies.RECORDS, near_copies.Likeness()])
def test_near_copies_equal_brute_force(spark, like):
    rows = near_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    found = near_copies.near_copies(df, like)
    pairs = near_copies.all_record_pairs(found, block=8)
    got = {tuple(r) for r in pairs.collect()}
    want, judged = brute(rows, like)
    assert got == set(want) and pairs.count() == len(got)
    out = near_copies.groups(found).collect()
    assert {r.record_id for r in out} == judged and len(out) == len(judged)
    group = {r.record_id: r.group_id for r in out}
    assert all(group[a] == group[b] for a, b in want) and all(g <= r for r, g in group.items())
    assert {r.copies for r in out if r.record_id.startswith("copy")} == {31}
    close = found.pairs.collect()
    assert all(abs(p.similarity - p.estimated) < like.margin for p in close)


def test_a_bucket_in_blocks_loses_no_pair(spark, monkeypatch):
    """A template with many fillings: half of all records share most bands; blocks of five classes, every candidate checked, any partitioning."""
    monkeypatch.setattr(near_copies, "BLOCK", 5)
    rng = random.Random(4)
    base = text(rng, 60)
    rows = [(f"t{i:03d}", f"{base} {i}", T0) for i in range(70)] + [(f"t{i:03d}c", f"{base} {i % 3}", T0) for i in range(50)] + [(f"u{i:03d}", text(rng, 40), T0) for i in range(60)]
    rows = [(*r, 1, "x", 2, 3, 4) for r in rows]
    like = near_copies.Likeness(words=3, margin=1.0)
    want, _ = brute(rows, like)
    found = near_copies.near_copies(spark.createDataFrame(rows, DOCS).repartition(7), like)
    pairs = near_copies.all_record_pairs(found, block=8).collect()
    assert {tuple(r) for r in pairs} == set(want) and len(pairs) == len(want) > 5000


def test_near_copies_of_nothing(spark):
    df = spark.createDataFrame([], DOCS)
    found = near_copies.near_copies(df)
    assert near_copies.all_record_pairs(found).count() == 0 and near_copies.groups(found).count() == 0
    only = near_copies.near_copies(spark.createDataFrame([("a", None, T0, 1, "", 1, 1, 1)], DOCS))
    assert near_copies.groups(only).count() == 0


def test_every_record_has_a_group(spark, tmp_path):
    ten = [f"w{i}" for i in range(10)]
    texts = {
        "a1": "Muito obrigado!", "a2": "muito  OBRIGADO", "a3": "obrigado muito", "b1": " ".join(ten), "b2": " ".join(ten).upper(), "b3": " ".join([*ten, "w10"]), "b4": " ".join(["x", "y", *ten[2:]]),
        "c1": None, "c2": None, "d1": "", "d2": "", "e1": "***", "f1": text(random.Random(3), 25),
    }
    rows = [(k, t, T0, 1, "x", 2, 3, 4) for k, t in texts.items()] + [("A-1", None, T0 - dt.timedelta(1), 1, "x", 2, 3, 4), ("d2", "x y", T0 - dt.timedelta(1), 1, "x", 2, 3, 4)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/normalized_document.parquet")
    out = near_copies.p3_groups(spark, str(tmp_path)).collect()
    first = {k: k for k in texts} | {"a2": "a1", "b2": "b1", "d2": "d1"}
    assert {r.record_id: r.class_id for r in out} == first and len(out) == len(texts)
    assert {r.record_id: r.group_id for r in out} == first | {"b3": "b1"}
    assert {r.record_id for r in out if r.copies == 2} == {"a1", "a2", "b1", "b2", "d1", "d2"} and {r.record_id for r in out if r.links} == {"b1", "b2", "b3"}
    assert {tuple(r) for r in near_copies.p3_found(spark, str(tmp_path)).collect()} == set()


def test_estimate_is_corrected_for_chance(spark):
    like, rng = near_copies.Likeness(), np.random.default_rng(1)
    for share in (0.0, 0.5, 0.9):
        guesses = []
        for _ in range(20):
            a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            keep = int(2000 * share / (1 + share))
            b = np.concatenate([a[:keep], rng.integers(0, 2**63, 1000 - keep, dtype=np.uint64)])
            x, y = near_copies._pack(near_copies._signatures([a, b], like), like).tolist()
            guesses.append((x, y))
        df = spark.createDataFrame(guesses, "x array<long>, y array<long>")
        mean = df.select(F.avg(near_copies.estimate(F.col("x"), F.col("y"), like))).first()[0]
        assert abs(mean - share) < 0.04


FIELDS = "example_id string, field_id string, original_text string, matchable boolean, doc_id long, text string"


def leak_case():
    rng = random.Random(3)
    items = [(f"e{i}", f"f{i}", text(rng, rng.choice([10, 14, 30, 60, 120])), i % 7 != 0, 1, "x") for i in range(40)]
    items += [("E-40", "f40", items[1][2], True, 1, "x"), ("e41", "f41", None, True, 1, "x"), (None, "f42", items[2][2], True, 1, "x"), ("e43", "f43", items[3][2], None, 1, "x"), ("e44", "f44", "", True, 1, "x")]
    docs = []
    for i in range(150):
        item = items[i % 40][2].split()
        start = rng.randrange(len(item))
        piece = item[start : start + rng.choice([5, 12, 13, 14, 60])]
        if i % 3 == 0:
            piece = edited(rng, items[i % 40][2], len(item) // 12).split()
        docs.append((i, f"{text(rng, 40)} {' '.join(piece).upper()}, {text(rng, 30)}"))
    docs += [(2**60 + 1, items[8][2]), (900, None), (901, ""), (902, items[5][2]), (902, items[5][2]), (903, text(rng, 50000) + " " + items[4][2]), (None, items[6][2]), (904, "ção " + "ã́" * 50)]
    return items, docs


def brute_leaks(items, docs):
    def runs(t, n):
        return {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}

    fields = [(re.sub("[^0-9a-z]", "", e.lower()), leakage.match_tokens(t)) for e, _, t, m, *_ in items if e and t is not None and m]
    out = set()
    for d, t in docs:
        w = leakage.match_tokens(t or "")
        long, short = runs(w, 13), runs(w, 5)
        for e, f in fields:
            if runs(f, 13) & long or len(f) >= 40 and 2 * len(runs(f, 5) & short) >= len(runs(f, 5)):
                out.add((d, e))
    return out


@pytest.mark.parametrize(("block", "shard"), [(leakage.BLOCK_CHARACTERS, leakage.SHARD_TOKENS), (900, 300)])
def test_leaks_equal_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(leakage, "BLOCK_CHARACTERS", block)
    items, docs = leak_case()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, example_id string, start int").repartition(3)
    fields = spark.createDataFrame(items, FIELDS)
    if shard < 1000:  # the workers take the module's value, so small shards are tested without them
        monkeypatch.setattr(leakage, "SHARD_TOKENS", shard)
        tests = leakage.TestTexts([(leakage.fold_key(e), f, t) for e, f, t, m, *_ in items if e and t is not None and m])
        held = [tests]
        frame = pd.DataFrame({"doc_id": [str(d) for d, _ in docs], "text": [t for _, t in docs]})
        got = {pair for part in leakage._scan(held, "doc_id")(iter([frame])) for pair in zip(part.doc_id, part.example_id, strict=True)}
        assert got == {(str(d), e) for d, e in brute_leaks(items, docs)}
    rows = leakage.find_leaks(df, fields).collect()
    assert {(r.doc_id, r.example_id) for r in rows} == brute_leaks(items, docs)
    assert {r.field_id for r in rows if r.doc_id is None} == {"f6"} and sum(r.doc_id == 902 for r in rows) == 2
    whole = next(r for r in rows if r.doc_id == 903)
    assert whole.start == 50000 and whole.longest == len(items[4][2].split())
    short = {r.field_id: r.tokens for r in leakage.too_short(fields).collect()}
    assert short == {f: len(leakage.match_tokens(t)) for e, f, t, m, *_ in items if e and t is not None and m and len(leakage.match_tokens(t)) < 13}
    clean = leakage.without_leaks(df, leakage.find_leaks(df, fields))
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} & {r.doc_id for r in rows} <= {None}


def test_suffix_array_sorts_whole_suffixes():
    rng = random.Random(6)
    for size, words in [(0, 1), (1, 1), (60, 1), (300, 2), (400, 40)]:
        codes = {f"w{k}": k for k in range(words)}
        sizes = [size // 2 + 1, 1, size - size // 2 + 1]
        ids = np.array([x for n in sizes for x in [*[rng.randrange(words) for _ in range(n - 1)], -1]], dtype=np.int64)
        shard = leakage.Shard(codes, ids.copy(), sizes)
        whole = shard.ids.tolist()
        assert shard.suffixes.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])


def test_longest_matches_equal_brute_force():
    rng = random.Random(2)
    docs = [[rng.choice("abc") for _ in range(rng.randrange(0, 90))] for _ in range(12)] + [["a"] * 120, ["a"] * 80]
    fields = [("e", f"f{i}", " ".join(rng.choice("abc") for _ in range(rng.randrange(13, 70)))) for i in range(12)] + [("e", "f12", " ".join("a" * 50)), ("e", "f13", " ".join(docs[3]))]
    tests = leakage.TestTexts(fields)
    codes = {w: i for i, w in enumerate("abc")}
    shard = leakage.Shard(codes, np.array([x for d in docs for x in [*[codes[w] for w in d], -1]], dtype=np.int64), [len(d) + 1 for d in docs])
    got = {(d, f): (n, s) for d, x, n, s, _, _ in shard.search(tests) for _, f in tests.owners[x] if n}
    want = {}
    for d, doc in enumerate(docs):
        for _, f, t in fields:
            field = t.split()
            best = max(((n, -i) for i in range(len(doc)) for j in range(len(field)) for n in [next((k for k in range(len(doc)) if i + k >= len(doc) or j + k >= len(field) or doc[i + k] != field[j + k]), len(doc))]), default=(0, 0))
            if best[0] >= leakage.ADJACENT:
                want[d, f] = (best[0], -best[1])
    assert got == want and want


def test_leaks_of_nothing(spark):
    items, docs = leak_case()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    fields = spark.createDataFrame(items, FIELDS)
    assert leakage.find_leaks(df, fields.limit(0)).count() == 0
    assert leakage.find_leaks(df.limit(0), fields).count() == 0


def test_match_tokens():
    assert leakage.match_tokens("Ação_ÉTICA: 3,14 Straße n.º") == ["acao", "etica", "3", "14", "strasse", "n", "º"]


@pytest.fixture(scope="module")
def samples():
    return list(pd.read_parquet(SAMPLES)[["lang", "text"]].itertuples(index=False, name=None))


def judge(machine, texts):
    sums = np.array([machine.score_words([w for w in t.split() if language.has_letter(w)]).sum(axis=0) for t in texts])
    which, confidence = machine.decide(sums)
    return [machine.languages[k] for k in which], confidence


def test_held_out_samples(samples):
    order = np.random.default_rng(1).permutation(len(samples))
    known, held = [samples[i] for i in order[::2]], [samples[i] for i in order[1::2]]
    machine = language.Discriminator(sorted({x for x, _ in samples}), language.FAMILIES).fit(known)
    got, confidence = judge(machine, [t for _, t in held])
    assert np.mean([a == b for a, (b, _) in zip(got, held, strict=True)]) >= 0.99
    assert ((confidence >= 0.5) & (confidence <= 1)).all()
    machine.calibrate(held)
    views = [(x, v) for x, t in held for v in language._views(t) if v]
    got, confidence = judge(machine, [" ".join(v) for _, v in views])
    right = np.array([a == b for a, (b, _) in zip(got, views, strict=True)])
    assert abs(confidence.mean() - right.mean()) < 0.03  # said and true agree
    bare = ["".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)).upper() for _, t in held]
    assert np.mean([a == b for a, (b, _) in zip(judge(machine, bare)[0], held, strict=True)]) >= 0.98
    broken = [t.encode().decode("latin-1") for _, t in held]
    assert np.mean([a == b for a, (b, _) in zip(judge(machine, broken)[0], held, strict=True)]) >= 0.98
    pieces = [(x, " ".join(t.split()[i : i + 6])) for x, t in held for i in range(0, len(t.split()) - 5, 6)]
    assert np.mean([a == b for a, (b, _) in zip(judge(machine, [t for _, t in pieces])[0], pieces, strict=True)]) >= 0.96


def test_paragraphs():
    assert [p.strip() for p in language.paragraphs("a\r\n \r\nb\nc\n\n\n\nd")] == ["a", "b\nc", "d"]
    assert language.paragraphs("\n\n a \n") != [] and language.paragraphs(" \n\n ") == [] == language.paragraphs("")


def test_identify(spark, samples):
    by = {}
    for lang, t in samples:
        by.setdefault(lang, []).append(t)
    table = spark.createDataFrame(samples, "lang string, text string").withColumn("sample_id", F.lit(1))
    machine = language.fit_discriminator(table)
    mixed = f"{by['pt'][0]} {by['pt'][1]}\r\n\t\r\n{by['en'][0]}\n\n12 34 5,6\n\nok"
    rows = [(1, mixed, "x"), (2, None, "x"), (3, "", "x"), (4, " \n\n ", "x"), (5, "1 2 3", "x"), (6, "\n\n".join(by["de"][:40]) * 60, "x"), (1, by["gl"][0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, para_no string")
    out = language.identify(df, machine)
    got = sorted(((r.doc_id, r.para_no, r.lang) for r in out.collect() if r.doc_id < 6), key=str)
    want = [(1, 0, "gl"), (1, 0, "pt"), (1, 1, "gl"), (1, 1, "pt"), (1, 2, "en"), (1, 3, None), (1, 4, "pt"), (2, 0, None), (3, 0, None), (4, 0, None), (5, 0, None), (5, 1, None)]
    assert got == sorted(want, key=str)
    assert {r.lang for r in out.collect() if r.doc_id == 6} == {"de"}
    assert all(0 <= r.confidence <= 1 for r in out.collect())
    assert language.identify(df.limit(0), machine).count() == 0
    aliases = spark.createDataFrame([("Português", "pt"), ("EN-us", "en"), (None, "x")], "alias string, lang string")
    named = spark.createDataFrame([(1, "a", "português"), (2, "a", "en_US"), (3, "a", "??"), (4, "a", None)], "doc_id long, text string, lang string")
    assert sorted((r.doc_id, r.label_lang) for r in language.labelled(named, aliases).collect()) == [(1, "pt"), (2, "en"), (3, None), (4, None)]
