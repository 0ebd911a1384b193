"""Operators over documents: edge cases and brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.llm import decontam, licenses, minhash, mixing, passages, pii, spotsigs, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, score double"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, 0.5) for i, t in rows], SCHEMA)


def _corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.choice((3, 25, 60, 120)))) for _ in range(n)]
    for i in range(0, n, 3):  # near copies
        words = texts[rng.randrange(n)].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts[i] = " ".join(words)
    texts[5] = "a " * 50
    texts[8] = " ".join(texts[9].split()[:40] + texts[11].split()[:40])
    return [*enumerate(texts), (1000, None), (1001, ""), (1002, " \n"), (1003, texts[1]), (1003, texts[1]), (None, texts[2]), (1004, "only Three Words"), (1005, "ONLY three words")]


def test_minhash_brute_force(spark):
    rows = _corpus()
    sets = {}
    for i, t in rows:
        words = WORD.findall((t or "").lower())
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        if i is not None:
            sets[i] = own
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low[a] = min(low[a], low[b])
    got = minhash.near_duplicates(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (low[r.doc_id], len(sets[r.doc_id]), low[r.doc_id] == r.doc_id)
    kept = minhash.keep_one(_docs(spark, rows))
    assert kept.columns == _docs(spark, []).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id is not None) == sorted((False, i) for i in sets if low[i] == i)
    assert minhash.near_duplicates(_docs(spark, [])).count() == 0


def test_chain_across_components(spark):
    """Links that a key's smallest member does not show are still found."""
    rng = random.Random(1)
    base = [f"x{i}" for i in range(100)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in rng.sample(range(100), 2):
            words[k] = f"y{i}_{k}"
        rows.append((i, " ".join(words)))
    rows.append((99, " ".join(base)))
    assert {r.component_id for r in minhash.near_duplicates(_docs(spark, rows)).collect()} == {0}


def test_minhash_recall_at_the_bound(spark):
    # 18 of 24 shingles in common: exactly the least similarity of a link; and 17 of 25, no link
    rows = []
    for i in range(400):
        words = [f"p{i}w{k}" for k in range(25)]
        for n, changed in enumerate((0, 3, 4)):
            rows.append((10 * i + n, " ".join(words[: 25 - changed] + [f"z{i}n{n}k{k}" for k in range(changed)])))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(_docs(spark, rows)).collect()}
    assert all(got[10 * i + 1] == 10 * i and got[10 * i + 2] == 10 * i + 2 for i in range(400))


def test_minhash_several_texts_of_one_id(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(5, a), (5, b), (7, a), (9, b), (9, b), (3, "other words of no other text at all")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(_docs(spark, rows)).collect())
    assert got == [(3, 3, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (9, 5, False)]
    kept = minhash.keep_one(_docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [3, 5]


def test_large_group_is_contracted_before_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "SPREAD", 4)
    rng, base, rows, sets = random.Random(11), [f"g{k}" for k in range(80)], [], {}
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(80), rng.randrange(5)):
            words[k] = f"h{i}_{k}"
        rows.append((i, " ".join(words)))
        sets[i] = {tuple(words[k : k + 5]) for k in range(76)}
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            low[a] = min(low[b] for b in sets if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(_docs(spark, rows)).collect()} == low


def test_repeats_brute_force(spark):
    rows = [(i, t) for i, t in _corpus() if i is not None and i != 1003]
    seen, lost = {}, {i: set() for i, _ in rows}
    for i, t in sorted(rows):
        words = WORD.findall(t or "")
        for p in range(len(words) - 19):
            key = tuple(words[p : p + 20])
            if key in seen:
                lost[i] |= set(range(p, p + 20))
            seen.setdefault(key, (i, p))
    got = {r.doc_id: r for r in passages.remove_repeats(_docs(spark, rows)).collect()}
    for i, t in rows:
        words = WORD.findall(t or "")
        kept = " ".join(w for p, w in enumerate(words) if p not in lost[i])
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(words), len(lost[i]), hashlib.sha256(kept.encode()).hexdigest())
    assert passages.remove_repeats(_docs(spark, [])).count() == 0
    odd = passages.remove_repeats(_docs(spark, _corpus())).collect()
    assert len(odd) == len(_corpus())


def test_repeats_under_shared_and_null_ids(spark):
    part = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    p, q, r = part("p", 30), part("q", 30), part("r", 30)
    rows = [(1, q), (4, f"{part('a', 100)} {p}"), (4, f"{p} {part('b', 5)}"), (5, f"{part('x', 100)} {r} {r}"), (5, part("c", 5)), (8, f"{part('e', 300)} {q}"),
            (None, q), (None, part("n", 40)), (9, p), (9, p)]
    got = {}
    for x in passages.remove_repeats(_docs(spark, rows)).collect():
        got.setdefault(x.doc_id, []).append((x.n_words, x.n_removed))
    assert sorted(got[4]) in ([(35, 0), (130, 30)], [(35, 30), (130, 0)])
    assert sorted(got[5]) == [(5, 0), (160, 30)]
    assert got[8] == [(330, 30)] and got[1] == [(30, 30)] and sorted(got[None]) == [(30, 0), (40, 0)] and got[9] == [(30, 30)] * 2


def test_repeats_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_BYTES", 2000)
    monkeypatch.setattr(passages, "CHUNK", 50)
    rng = random.Random(8)
    shared = [" ".join(f"s{j}x{i}" for i in range(rng.randrange(20, 60))) for j in range(6)]
    rows = []
    for i in range(80):
        parts = [" ".join(f"u{i}x{j}x{k}" for k in range(rng.randrange(30))) for j in range(4)]
        words = " ".join(x for j in range(4) for x in (parts[j], rng.choice(shared))).split()
        rows.append((i, " ".join(words[rng.randrange(15) :])))
    seen, lost = {}, {}
    for i, t in rows:
        words, lost[i] = t.split(), set()
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                lost[i] |= set(range(k, k + 20))
            seen.setdefault(key, i)
    got = {x.doc_id: x for x in passages.remove_repeats(_docs(spark, rows)).collect()}
    for i, t in rows:
        assert got[i].kept_text == " ".join(w for k, w in enumerate(t.split()) if k not in lost[i])


def test_automaton_tells_colliding_letters_apart():
    import pyarrow as pa

    t = passages.word_table(pa.array([" ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))]))
    t.hash[25:] = (t.hash[:25] & np.uint64(0xFFFF)) | np.uint64(1 << 40)  # other words of equal letters
    code, zero = t.hash.astype("<u2"), np.zeros(1, np.int64)
    blobs = [(passages._pack([zero + 7, zero.astype("<i4"), zero.astype("<i4"), zero.astype("<i4") + 25, t.hash[a : a + 25].sum(keepdims=True)]), code[a : a + 25].tobytes()) for a in (0, 25)]
    both = passages._Shard(blobs).repeated(t, np.array([1, 7]), np.array([0, 0], np.int32))
    assert both[:25].all() and not both[25:].any()  # the second is the first place of its passage
    assert not passages._Shard(blobs[:1]).repeated(t, np.array([7, 1]), np.array([0, 0], np.int32)).any()


def test_repeats_of_every_period(spark):
    # every text has its own words, so only it can make its names recur
    rows = [(100 * period + n, " ".join(f"v{period}x{n}x{i % period}" for i in range(period * n + 5))) for period in range(1, 41) for n in (2, 3, 9)]
    got = {r.doc_id: r.n_removed for r in passages.remove_repeats(_docs(spark, rows)).collect()}
    for i, t in rows:
        words, seen, lost = t.split(), set(), set()
        for p in range(len(words) - 19):
            if tuple(words[p : p + 20]) in seen:
                lost |= set(range(p, p + 20))
            seen.add(tuple(words[p : p + 20]))
        assert (i, got[i]) == (i, len(lost))


def _spots(text):
    """Brute force: chains of three content words after every common word, as word tuples."""
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())
    common = set(spotsigs.ANCHORS.split())
    out = set()
    for i, w in enumerate(words):
        after = [v for v in words[i + 1 :] if v not in common][: spotsigs.CHAIN]
        if w in common and len(after) == spotsigs.CHAIN:
            out.add((w, *after))
    return out or {tuple(words[i : i + spotsigs.CHAIN + 1]) for i in range(len(words))}


def test_signatures_brute_force():
    rng = random.Random(4)
    words = spotsigs.ANCHORS.split()[:20] + [f"c{i}" for i in range(25)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice((0, 2, 9, 60)))) for _ in range(60)] + ["Über alles, the Straße, x y Z the end"]
    own, want = spotsigs.signatures(__import__("pyarrow").array(texts)), [_spots(t) for t in texts]
    assert [len(s) for s in own] == [len(w) for w in want]
    for i in range(0, len(texts) - 1):
        union = want[i] | want[i + 1]
        assert spotsigs.likeness(own[i], own[i + 1]) == pytest.approx(len(want[i] & want[i + 1]) / len(union) if union else 1.0)


def test_fingerprints_in_many_buckets(spark, monkeypatch):
    rows = [(i * 3 - 50, f"w{i} the quick fox number {i} of a chain of words {i * i}") for i in range(90)]
    one = sorted(map(tuple, spotsigs.fingerprints(_docs(spark, rows)).collect()))
    monkeypatch.setattr(spotsigs, "BUCKET_BYTES", 300)
    assert sorted(map(tuple, spotsigs.fingerprints(_docs(spark, rows)).collect())) == one and len(one) == 90


def test_fingerprints(spark):
    rows = [(i, t) for i, t in _corpus() if i is None or i != 1003] + [(2000, "the über quick brown fox of long chains and more words here")]
    got = spotsigs.fingerprints(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    order = sorted(((-1 if i is None else i), t or "") for i, t in rows)
    own = {(-1 if r.doc_id is None else r.doc_id): r for r in got}
    for n, (i, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        assert own[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and own[i].n_chars == len(t)
        sets = spotsigs.signatures(__import__("pyarrow").array([t, edited, after]))
        assert own[i].fingerprint == spotsigs.written(sets[0]) and own[i].edited_fingerprint == spotsigs.written(sets[1])
        assert own[i].near_edited == pytest.approx(spotsigs.likeness(sets[0], sets[1])) and own[i].near_next == pytest.approx(spotsigs.likeness(sets[0], sets[2]))
    assert spotsigs.fingerprints(_docs(spark, [])).count() == 0
    one = spotsigs.fingerprints(_docs(spark, [(4, "a b c d")])).first()
    assert one.near_next == 1.0
    assert spotsigs.likeness(np.arange(2), np.arange(9), 0.5) == 0.0


def test_toxicity_learns_a_pair(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        words = [f"v{rng.randrange(50)}" for _ in range(12)]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words += ["insulta"] * a + ["groupb"] * b
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(a and b)))
    rows += [(5000, None), (5001, ""), (None, "insulta groupb")]
    docs, lab = _docs(spark, rows), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert {r.doc_id for r in got if r.held_out} == {i for i, _ in rows if i is not None and __import__("zlib").crc32(str(i).encode()) % 3 == 1}
    kept = toxicity.reject_toxic(docs, lab)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got)
    empty = lab.limit(0)
    assert toxicity.toxicity(docs, empty).where("predicted = 1").count() == 0
    assert toxicity.toxicity(docs.limit(0), lab).count() == 0


def test_pair_weights_are_a_double_sum():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    m = toxicity.Machine(0.3, rng.normal(size=toxicity.DIMS), rng.normal(size=(toxicity.FACTORS, toxicity.DIMS)))
    texts = ["One two three one", "", None, "überlang wörter"]
    got = m.logits(*toxicity.slots(pa.array(texts)), len(texts))
    for i, text in enumerate(texts):
        own = toxicity.slots(pa.array([text], pa.string()))[1]
        pairs = sum(float(m.v[:, a] @ m.v[:, b]) for k, a in enumerate(own) for b in own[k + 1 :])
        assert got[i] == pytest.approx(0.3 + m.w[own].sum() + pairs)


def test_toxicity_learns_what_no_sum_of_weights_can():
    # toxic: exactly one of two terms, so neither has a weight of its own
    rng = np.random.default_rng(5)
    sets, toxic = [], []
    for _ in range(4000):
        a, b = rng.integers(0, 2, 2)
        sets.append(np.unique(np.concatenate((rng.integers(100, 130, 5), [10] * a, [20] * b))).astype(np.int32))
        toxic.append(a ^ b)
    m = toxicity.train(sets, np.array(toxic, float))
    text = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    assert np.mean((m.scores(text, np.concatenate(sets), len(sets)) > 0.5) == np.array(toxic)) > 0.95


def test_isotonic_brute_force():
    rng = np.random.default_rng(11)
    for n in (1, 2, 7, 40):
        z, toxic = np.round(rng.normal(size=n), 1), rng.integers(0, 2, n)
        x, p = toxicity.isotonic(z, toxic)
        order = np.lexsort((toxic, z))
        y, w = toxic[order].astype(float), np.where(toxic[order] > 0, toxicity.TOXIC_WEIGHT, 1.0)
        # the rising fit at i: the largest, over starts, of the least mean up to any end
        mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
        truth = [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(np.unique(np.round(truth, 9)), np.unique(np.round(p, 9))) and (np.diff(x) >= 0).all()


def test_toxicity_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()
    share = {r.toxic: r.share for r in rows}
    assert share[1] >= 0.6 and share[0] <= 0.02


def test_kin_terms_have_slots_of_their_own():
    import pyarrow as pa

    got = [set(toxicity.slots(pa.array([x]))[1].tolist()) for x in ("stemma", "stemma stemma", "stemma stemmb", "stemmb stemma stemma")]
    assert got[0] == got[1] and got[2] == got[3] and len(got[0]) == 2 and len(got[2]) == 4


def test_decontamination(spark):
    rng = random.Random(4)
    item = [f"t{rng.randrange(500)}" for _ in range(40)]
    noise = lambda n: [f"n{rng.randrange(5000)}" for _ in range(n)]
    swapped = [("zz" if k % 9 == 4 else w) for k, w in enumerate(item)]
    rows = [
        (1, " ".join(noise(30) + item + noise(30))), (2, " ".join(noise(30) + swapped + noise(5))), (3, " ".join(noise(80))), (4, None), (5, ""), (None, " ".join(item).upper()),
        (6, " ".join(noise(9) + item[5:25])), (7, " ".join(item[:6] + noise(30))), (8, "xx one two three four five six yy"), (9, "one two three four nine six"),
    ]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, "One, two three four five six"), (12, "hi"), (13, None), (None, "x")], "item_id long, text string")
    docs = _docs(spark, rows)
    got = {r.doc_id: r for r in decontam.contamination(docs, bench).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 6, 8, None}
    assert (got[1].item_id, got[1].first_term, got[1].last_term, got[8].item_id) == (10, 30, 69, 11)
    assert {r.doc_id for r in decontam.decontaminate(docs, bench).collect()} == {3, 4, 5, 7, 9}
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    clash = docs.select("*", *(F.lit(9).alias(c) for c in ("k", "t", "seed", "item_id", "start", "_item")))
    assert {r.doc_id for r in decontam.contamination(clash, bench).where("contaminated").collect()} == {1, 2, 6, 8, None}
    assert decontam.decontaminate(clash, bench).columns == clash.columns and decontam.decontaminate(clash, bench).count() == 5
    assert decontam.contamination(docs.limit(0), bench).count() == 0


def _overlaps(own, item):
    """Brute force: the longest stretch between first and last accepted windows of one diagonal."""
    size, best = min(decontam.WORDS, len(item)), None
    for shift in range(-len(item), len(own)) if len(item) >= decontam.LEAST else ():
        good = [p for p in range(max(shift, 0), min(shift + len(item), len(own)) - size + 1) if sum(own[p + i] == item[p + i - shift] for i in range(size)) >= decontam.need(size)]
        if good:
            best = max(best or (0,), (good[-1] + size - good[0],))
    return best


def test_seeds_reach_all_that_is_verified(spark):
    from itertools import combinations

    items, rows, rng = [], [], random.Random(7)
    for size in range(decontam.LEAST, decontam.WORDS + 1):
        item = [f"s{size}t{i}" for i in range(size)]
        items.append((size, " ".join(item)))
        for k in range(size - decontam.need(size) + 1):
            for gone in combinations(range(size), k):
                rows.append((len(rows), " ".join(["n1", "n2", *("zz" if i in gone else w for i, w in enumerate(item)), "n3"]), size, 2, size))
    # a longer item of which only 13 terms occur, two of them substituted
    item = [f"l{i}" for i in range(30)]
    items.append((30, " ".join(item)))
    for gone in combinations(range(8, 21), 2):
        rows.append((len(rows), " ".join(["n", *("zz" if i in gone else w for i, w in enumerate(item) if 8 <= i < 21), "n"]), 30, 1, 13))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontam.contamination(_docs(spark, [r[:2] for r in rows]), bench).collect()}
    for i, text, item_id, first, size in rows:
        # where the ends are substituted the stretch may lie further on
        assert got[i].item_id == item_id and got[i].last_term - got[i].first_term >= size - 1, text
        assert item_id == 30 or (got[i].first_term, got[i].last_term) == (first, first + size - 1), text


def test_decontamination_brute_force(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    items = [[rng.choice(words) for _ in range(n)] for n in (3, 5, 6, 8, 10, 12, 20, 45)]
    rows = []
    for i in range(120):
        item = rng.choice(items)
        a = rng.randrange(len(item))
        part = [w if rng.random() > 0.1 else rng.choice(words) for w in item[a // 2 :]]
        rows.append((i, " ".join([*(f"n{rng.randrange(900)}" for _ in range(rng.randrange(40))), *part, *(rng.choice(words) for _ in range(rng.randrange(30)))])))
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    for r in decontam.contamination(_docs(spark, rows), bench).collect():
        found = [(-got[0], k) for k, item in enumerate(items) if (got := _overlaps(rows[r.doc_id][1].split(), item))]
        want = min(found, default=None)
        assert (r.item_id, r.contaminated and r.first_term - r.last_term - 1) == ((want[1], want[0]) if want else (None, False)), rows[r.doc_id]


def test_pii(spark):
    rows = [(1, "card 4111 1111 1111 1111, 4111111111111111; bad 4111111111111112"), (2, "on 2024-02-29 or 2023-02-30 and 31.12.1999"), (3, "from 10.0.0.255. not 300.1.1.1, ssn 123-45-6789 not 666-45-6789"),
            (4, "me.too@x.org or +1 (743) 555-3824"), (5, "DE89 3704 0044 0532 0130 00"), (6, None), (7, ""), (8, "plain words"), (8, "plain words"), (None, "4111111111111111")]
    got = pii.pseudonymize(_docs(spark, rows), key="k", count="n").collect()
    text = {r.doc_id: r.text for r in got}
    luhn = lambda s: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0
    spaced, plain = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", text[1])[:2]
    assert spaced.replace(" ", "") == plain == text[None] and plain != "4111111111111111" and luhn(plain) and "4111111111111112" in text[1]
    assert "2023-02-30" in text[2] and "2024-02-29" not in text[2] and "31.12.1999" not in text[2]
    assert "300.1.1.1" in text[3] and "666-45-6789" in text[3] and "10.0.0.255" not in text[3] and "123-45-6789" not in text[3]
    assert re.fullmatch(r"[a-z]{2}\.[a-z]{3}@x\.org or \+1 \(\d{3}\) \d{3}-\d{4}", text[4]) and "555-3824" not in text[4]
    iban = text[5].replace(" ", "")
    assert len(text[5]) == 27 and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert text[6] is None and text[7] == "" and text[8] == "plain words"
    assert sum(r.n for r in got) == 2 + 2 + 2 + 2 + 1 + 1
    # a permutation: different values of a small format stay different
    dates = spark.range(2000).select(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pii.pseudonymize(dates, key="k").distinct().count() == 2000
    assert pii.pseudonymize(_docs(spark, []), key="k").count() == 0


def test_pii_beside_other_numbers(spark):
    card, bank = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"
    texts = [f"{card} 123", f"{card} 12/27", f"3 {card}", f"1 2 3 4 5 6 7 8 {card} 9", f"{card} {card}", f"{bank} EUR", f"{bank} USDT", f"{bank} {card}", f"{bank} {bank}",
             f"{card} 12/31/1999", "7 2024-02-29 1200", "123-456-7890 1234", f"{card} 123-45-6789", "XX98", "j@firm.com", "7@firm.com", "4111111111111111"]
    got = {r.doc_id: r for r in pii.pseudonymize(_docs(spark, list(enumerate(texts))), key="k", count="n").collect()}
    for i, text in enumerate(texts):
        new = got[i].text
        assert len(new) == len(text) and card not in new and bank not in new and "12/31/1999" not in new and "2024-02-29" not in new and "123-45-6789" not in new, new
    assert [got[i].n for i in (0, 4, 5, 7, 8, 9, 10, 11, 12, 14, 15)] == [1, 2, 1, 2, 2, 2, 1, 1, 2, 1, 1]
    assert got[0].text.endswith(" 123") and got[1].text.endswith(" 12/27") and got[5].text.endswith(" EUR") and got[3].text.startswith("1 2 3 4 5 6 7 8 ")
    assert re.fullmatch("[a-z]@firm.com", got[14].text) and got[14].text[0] != "j" and re.fullmatch("[0-9]@firm.com", got[15].text)
    # equal values keep equal pseudonyms
    plain = got[16].text
    assert {got[i].text.replace(" ", "")[:16] for i in (0, 1, 4)} == {plain}
    assert pii.pseudonymize(_docs(spark, [(1, "7" * 20000 + " " + card), (2, "12 " * 2000 + card)]), key="k", count="n").agg(F.min("n")).first()[0] >= 1


def test_pii_keys_dates_and_names(spark):
    days = [f"{d:02}/{m:02}/{y}" for y in (1999, 2024) for m in range(1, 13) for d in (13, 21, 28)]
    docs = spark.createDataFrame([(i, d, 1, "x") for i, d in enumerate(days)], "doc_id long, text string, _pii_new int, _PII_gaps string")
    got = pii.pseudonymize(docs, key="one").collect()
    new = [r.text for r in got]
    assert len(set(new)) == len(days) and not set(new) & set(days) and all(re.fullmatch(r"(1[3-9]|2\d|3[01])/(0\d|1[0-2])/\d{4}", d) for d in new)
    assert {(r["_pii_new"], r["_PII_gaps"]) for r in got} == {(1, "x")} and got[0].asDict().keys() == {"doc_id", "text", "_pii_new", "_PII_gaps"}
    other = [r.text for r in pii.pseudonymize(docs, key="two").collect()]
    assert sum(a == b for a, b in zip(new, other, strict=True)) < 3
    spark.conf.unset(pii.KEY_SETTING)
    key = pii.session_key(spark)
    assert len(key) == 64 and pii.session_key(spark) == key


def test_feistel_is_undone_by_its_key():
    """Brute force in plain Python: the rounds run backwards give the value back."""
    from hashlib import sha256

    def shift(key, r, j, other):
        return int(sha256(",".join([key, str(r), str(j), ".".join(map(str, other))]).encode()).hexdigest()[:10], 16)

    def forth(v, bases, key):
        h = len(v) // 2
        a, b, p, q = v[:h], v[h:], bases[:h], bases[h:]
        for r in range(1, pii.ROUNDS + 1):
            a, b, p, q = b, [(x + shift(key, r, j, b)) % p[j] for j, x in enumerate(a)], q, p
        return a + b

    def back(v, bases, key):
        h = len(v) // 2
        a, b, p, q = v[:h], v[h:], bases[:h], bases[h:]
        for r in range(pii.ROUNDS, 0, -1):
            a, b, p, q = [(x - shift(key, r, j, a)) % q[j] for j, x in enumerate(b)], a, q, p
        return a + b

    spark = __import__("pyspark").sql.SparkSession.getActiveSession()
    for bases in ([10] * 4, [26, 10, 10, 26, 26], [270, 271]):
        rows = [[(i * 7 + k * 3) % b for k, b in enumerate(bases)] for i in range(40)]
        sql = pii._feistel("v", "array(" + ",".join(f"{b}L" for b in bases) + ")", "k1")
        for r in spark.createDataFrame([(x,) for x in rows], "v array<bigint>").select("v", F.expr(sql).alias("n")).collect():
            # half of an odd number of places swaps sizes each round; an even number of rounds restores them
            assert r.n == forth(r.v, bases, "k1") and back(r.n, bases, "k1") == r.v


def test_mixing(spark):
    rng = random.Random(6)
    words = {"en": "the of and with this that", "de": "der und die nicht schön für", "fr": "la les été que çà dès", "es": "el los señor canción que así"}
    rows = [(i, " ".join(rng.choice(words[lang].split()) for _ in range(rng.randrange(5, 60))), lang) for i, lang in enumerate(rng.choices(list(words), (6, 2, 1, 1), k=400))]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "", None), (None, "the of", "en")], "doc_id long, text string, lang string")
    targets = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
    labelled = docs.where("doc_id < 200").select("doc_id", F.col("lang").alias("domain"))
    got = mixing.mix(docs, labelled, targets).collect()
    assert len(got) == 403 and all(r.rate >= 0 for r in got)
    total = sum(r.tokens * r.rate for r in got)
    for k, share in enumerate(targets.values()):
        assert sum(r.tokens * r.rate * r[f"p_{k}"] for r in got) / total == pytest.approx(share, abs=1e-3)
    assert sum(r.copies * r.tokens for r in got) == pytest.approx(total, rel=0.1)
    assert {r.rate for r in got if not r.tokens} == {1.0}
    assert mixing.mix(docs.limit(0), labelled, targets).count() == 0


def test_posteriors_brute_force(spark):
    import math

    texts = {1: "Red, red fish!", 2: "blue bird", 3: "red bird\tsings", 4: "", 5: None, 6: "fish (bird) unseen"}
    docs = _docs(spark, list(texts.items()))
    labelled = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (2, "other"), (99, "a")], "doc_id long, domain string")
    terms = {i: set(re.sub(r"[,!()\t]", " ", (t or "").lower()).split()) for i, t in texts.items()}
    slot = {r.t: r.s[0] for r in spark.createDataFrame([(w,) for w in set().union(*terms.values())], "t string").select("t", mixing._slots(F.col("t")).alias("s")).collect()}
    assert len(set(slot.values())) == len(slot)
    prior, weight = {"a": math.log(2 / 5), "b": math.log(3 / 5)}, {}
    for d, own in (("a", (1,)), ("b", (2, 3))):
        n = {s: sum(s in {slot[w] for w in terms[i]} for i in own) for s in slot.values()}
        weight[d] = {s: math.log((c + 1) / (sum(n.values()) + mixing.SLOTS)) for s, c in n.items()}
    for r in mixing.posteriors(docs, labelled, ["a", "b"]).collect():
        own = [slot[w] for w in terms[r.doc_id]]
        score = {d: prior[d] + sum(weight[d][s] for s in own) / math.sqrt(max(len(own), 1)) for d in "ab"}
        assert r.p_0 == pytest.approx(1 / (1 + math.exp(score["b"] - score["a"])))
        assert r.p_0 + r.p_1 == pytest.approx(1) and r.tokens == len((texts[r.doc_id] or "").split())


def test_rates_where_targets_cannot_be_met(spark):
    # every text is half of both domains, so no rates give three quarters of one
    docs = _docs(spark, [(i, "same words here") for i in range(20)])
    labelled = spark.createDataFrame([(0, "a"), (1, "b")], "doc_id long, domain string")
    got = mixing.mix(docs, labelled, {"a": 0.75, "b": 0.25}).collect()
    # least squares: equal rates r with (r/2 - 1.5)^2 + (r/2 - 0.5)^2 least
    assert {round(r.rate, 3) for r in got} == {2.0}


def test_targets_that_weak_posteriors_can_meet(spark, monkeypatch):
    """Posteriors of 0.545 and 0.455 at most: plain gradient steps would take hundreds."""
    docs = _docs(spark, [(i, "w " * (5 + i % 7)) for i in range(220)])
    posteriors = docs.select("doc_id", F.size(F.split(F.trim("text"), " ")).cast("long").alias("tokens"), F.when(F.col("doc_id") % 2 == 0, 0.545).otherwise(0.455).alias("p_0")).withColumn("p_1", 1 - F.col("p_0"))
    monkeypatch.setattr(mixing, "posteriors", lambda *a, **k: posteriors)
    monkeypatch.setattr(mixing, "STEPS", 12)
    got = mixing.mix(docs, None, {"a": 0.53, "b": 0.47}).collect()
    total = sum(r.tokens * r.rate for r in got)
    assert sum(r.tokens * r.rate * r.p_0 for r in got) / total == pytest.approx(0.53, abs=1e-5) and all(r.rate >= 0 for r in got)


def test_mix_keeps_the_rows(spark):
    docs = spark.createDataFrame([(1, "der und", "de", 0.5, "x"), (1, "der und", "de", 0.5, "x"), (None, None, None, None, None), (2, "the of", "en", 9.0, "y")], "doc_id long, text string, lang string, rate double, _s string")
    labelled = spark.createDataFrame([(1, "de"), (2, "en")], "doc_id long, domain string")
    got = mixing.mix(docs, labelled, {"en": 0.5, "de": 0.5}, keep=True)
    assert got.columns == ["doc_id", "text", "lang", "_s", "tokens", "p_0", "p_1", "rate", "copies"]
    assert sorted((r.doc_id or 0, r.text or "", r._s or "", r.tokens) for r in got.collect()) == [(0, "", "", 0), (1, "der und", "x", 2), (1, "der und", "x", 2), (2, "the of", "y", 2)]


def test_the_secret_is_in_no_plan(spark):
    docs = _docs(spark, [(1, "mail j.doe@firm.com or 192.168.10.7")])
    made = pii.pseudonymize(docs, key="very-private-key")
    plan = made._jdf.queryExecution().toString() + spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "formatted")
    assert "very-private-key" not in plan and made.columns == docs.columns
    assert made.first().text == pii.pseudonymize(docs, key="very-private-key").first().text != pii.pseudonymize(docs, key="other").first().text


def test_patience():
    a, b = "x a b c y d e".split(), "a b q c d e".split()
    assert [a[i] for i, _ in licenses.patience(a, b)] == ["a", "b", "c", "d", "e"]
    assert licenses.patience([], b) == [] and licenses.patience(["a"] * 5, ["a"] * 3) == [(0, 0), (1, 1), (2, 2)]


def test_licenses(spark):
    rows = [(1, "code\nReleased under the MIT License.\nmore"), (2, "Licensed under the Apache License, Version 2.0."), (3, "a license of sorts under the sun"), (4, None), (5, ""), (6, "w " * 5000 + "This work is licensed under the GNU General Public License, version 3."), (None, "Licensed under CC BY-NC 4.0."), (7, "This work has been licensed under the GNU General Public License version 3")]
    got = {r.doc_id: r for r in licenses.scan_licenses(_docs(spark, rows)).collect()}
    assert {i: r.license for i, r in got.items()} == {1: "MIT", 2: "Apache-2.0", 3: None, 4: None, 5: None, 6: "GPL-3.0", None: "CC-BY-NC-4.0", 7: "GPL-3.0"}
    assert (got[6].coverage, got[6].first_word) == (1.0, 5000) and 0.8 <= got[7].coverage < 1
    assert licenses.scan_licenses(_docs(spark, [])).count() == 0


def test_licenses_with_words_missing(spark):
    rows, want = [], []
    for name, text in licenses.TEMPLATES.items():
        words = licenses._WORD.findall(text)
        spare = len(words) - licenses._need(words)
        for k in range(len(words) if spare else 0):
            # any one word, and as many as may be missing from there on
            for gone in ({k}, {(k + j) % len(words) for j in range(spare)}):
                left = [w for j, w in enumerate(words) if j not in gone]
                for joint, lead in ((" ", ""), ("\n", "ahead stand other lines\n")):
                    rows.append((len(rows), lead + joint.join(left)))
                    want.append((name, len(left) / len(words), len(lead.split())))
    got = {r.doc_id: r for r in licenses.scan_licenses(_docs(spark, rows)).collect()}
    for (i, _), (name, share, first) in zip(rows, want, strict=True):
        found = [(n.coverage, n.first_word) for n in got[i].notices if n.license == name]
        assert found == [(pytest.approx(share), first)], (rows[i], got[i])
    two = "Licensed under CC BY and x Licensed under CC BY 4.0 end"
    assert [(n.license, n.first_word) for n in licenses.scan_licenses(_docs(spark, [(1, two)])).first().notices if n.license == "CC-BY-4.0"] == [("CC-BY-4.0", 0), ("CC-BY-4.0", 6)]
    whole = "dedicated to the public\ndomain under CC0 1.0 Universal"
    assert licenses.scan_licenses(_docs(spark, [(1, whole)])).first().coverage == 1.0
