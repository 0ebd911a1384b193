"""Packing, filter audit and Merkle manifest against plain code, with their edge cases."""

import random
import re
from hashlib import sha256
from itertools import permutations
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pelagia.llm import encode, filter_audit, merkle, packing

TOKENS = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mask int, grp string, path string"


def _docs(spark, rows):
    """``rows`` of (doc_id, text, source), with columns that clash with the operators' own."""
    return spark.createDataFrame([(i, t, None if i == 3 else "en", s, None if i == 4 else len(t or ""), 7, "x", "y") for i, t, s in rows], SCHEMA)


def _corpus(n=150, seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab[: rng.choice((20, 400))]) for _ in range(rng.choice((3, 150, 230)))]
        words = [w.upper() if rng.random() < rng.choice((0.0, 0.2)) else w for w in words]
        text = rng.choice((" ", "\n")).join(words) + rng.choice(("", "", " $5"))
        rows.append((i, rows[rng.randrange(i)][1] if i and rng.random() < 0.3 else text, f"s{rng.choice((0, 0, 0, 1, 2))}"))
    odd = [(n, None, None), (n + 1, "", None), (n + 2, "é É\n", ""), (n + 3, "x\n" * 50_000, "s1"), (5, rows[5][1], "s0"), (5, rows[5][1], "s0"), (6, rows[5][1], "s9"), (None, rows[5][1], "s0"), (None, "a\nb", None)]
    return rows + odd


def _mask(text):
    t = text or ""
    words = WORD.findall(t)
    return [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t)]


def test_filter_audit_applies_every_order(spark):
    rows = _corpus()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 150, 3)] + [(3, 1, 1), (3, 0, None), (None, 1, 1), (9999, 1, 1)]
    known = {}
    for i, q, x in labels:
        old = known.get(i, (0, 0))
        known[i] = (max(old[0], q), max(old[1], x or 0))
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs = [(s or "", [*_mask(t), i is not None and i > first[t or ""]], *(known.get(i, (0, 0)) if i is not None else (0, 0))) for i, t, s in rows]
    want, shares = {}, {}
    for part in {d[0] for d in docs}:
        for order in permutations(range(5)):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order):
                gone, name = [d for d in left if d[1][f]], "".join("ABCDE"[g] for g in order)
                left = [d for d in left if not d[1][f]]
                failing = [d for d in docs if d[0] == part and d[1][f]]
                want[part, name, step + 1] = (len(left), len(gone), len(failing) - len(gone), sum(sum(d[1]) == 1 for d in failing), sum(d[2] for d in gone), sum(d[3] for d in gone))
                shares[part, f] = shares.get((part, f), 0) + len(gone)
    made = filter_audit.audit(_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost) for r in made}
    assert got == want and len(made) == len(want)
    assert all(r.shapley == shares[r.part, "ABCDE".index(r.filter_order[r.step - 1])] for r in made)


def test_filter_audit_cells_come_back_from_parity_sums(spark):
    rows = [("p", m, m * m + 1, m % 3, 0) for m in range(0, 32, 3)] + [("q", 31, 5, 0, 5)]
    sums = filter_audit.parity_sums(spark.createDataFrame(rows, "part string, mask int, n long, good long, toxic long"))
    one = {(r.part, r.label): r.sums for r in sums.collect()}
    assert one["q", "n"] == [5 * (-1) ** bin(w).count("1") for w in range(32)]
    cells = {r.part: r for r in filter_audit.mask_cells(sums).collect()}
    assert cells["p"].n == [m * m + 1 if m % 3 == 0 else 0 for m in range(32)] and cells["p"].good == [0] * 32 and cells["q"].toxic == [0] * 31 + [5]
    empty = filter_audit.audit(_docs(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert empty.count() == 0


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def _manifest(rows):
    """What a manifest must hold, from the definition."""
    leaf = lambda r, text: _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    every = {g: sorted(groups[g], key=lambda x: x[:3]) for g in names}
    trees = {g: _up([x[2] for x in every[g]]) for g in names}
    top, out = _up([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for i, (_, _, own, r) in enumerate(every[g]):
            cut = r.doc_id is not None and crc32(str(r.doc_id).encode()) % 2 == 0
            node, path = leaf(r, r.text.replace("\n", "") if cut and r.text is not None else r.text), []
            for levels, at in ((trees[g], i), (top, k)):
                for row in levels[:-1]:
                    a = at - at % 3
                    path += row[a:at] + row[at + 1 : a + 3]
                    node, at = _h(*row[a:at], node, *row[at + 1 : a + 3]), at // 3
            out.append((r.doc_id, own, trees[g][-1][0], top[-1][0], _h(*path), node, node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rise", [1, 2, 7])
def test_merkle_manifest_from_the_definition(spark, rise, monkeypatch):
    monkeypatch.setattr(merkle, "RUN_ROWS", 20)
    docs = _docs(spark, _corpus())
    got = merkle.verify(merkle.build(docs, rise)).collect()
    assert sorted(map(tuple, got), key=repr) == _manifest(docs.collect())
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_merkle_manifest_of_few_rows(spark, n):
    docs = _docs(spark, [(i, f"a\n{i}", "s") for i in range(n)])
    got = merkle.verify(merkle.build(docs, 1)).collect()
    assert sorted(map(tuple, got), key=repr) == _manifest(docs.collect())


def test_merkle_store_has_every_level_and_proofs_lead_to_the_root(spark):
    docs = _docs(spark, [(i, "t", f"s{i % 2}") for i in range(40)])
    made = merkle.build(docs, 2)
    sizes = {(r.grp, r.level): r.c for r in made.tree.nodes().groupBy("grp", "level").agg({"*": "count"}).withColumnRenamed("count(1)", "c").collect()}
    assert sizes == {(f"=s{k}", level): c for k in range(2) for level, c in enumerate((20, 7, 3, 1))}
    for r in merkle.proofs(made).collect():
        top, rest = merkle.fold(r.hash, r.idx, r.n, r.path)
        assert top == r.subroot and merkle.fold(top, r.source_idx, r.n_sources, rest) == (made.root, "")


ODD = ["a", "B", "'s", "'S", "\u00e9", "e\u0301", "\u0130", "\u03a3", "1", "\u00b2", ",", ".", "!?", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|", "<", " ", "\n", "\x0b", "\x1c", "\x85", "\u3000", "\u0338", "\u6f22", "\U0001f600", "don't", "\x00"]


def test_words_are_encoded_as_whole_texts_are():
    rng, whole, made = random.Random(2), Tokenizer.from_file(TOKENS), encode.WordEncoder(TOKENS)
    for _ in range(4):  # later batches meet words that are known
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(25))) for _ in range(1500)] + [None, ""]
        ids, first = made.encode(pa.array(texts))
        for t, a, z in zip(texts, first[:-1], first[1:], strict=True):
            assert ids[a:z].tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert made.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(encode, "KEPT_WORDS", 50)
    made, whole = encode.WordEncoder(TOKENS), Tokenizer.from_file(TOKENS)
    for k in range(5):
        text = " ".join(f"word{k}x{i}" for i in range(30))
        assert made.encode(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids and len(made.words.known) <= 60


def _checked(pieces, docs, window):
    """Every document whole in its pieces, every sequence gapless and full but one a range."""
    whole, want = Tokenizer.from_file(TOKENS), {}
    for i, t, _ in docs:
        want.setdefault(i, []).append(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    found, filled = {}, {}
    for p in pieces:
        found.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(found) == set(want)
    for i, texts in want.items():
        left = sorted(found[i])
        for ids in texts:
            at = 0
            while at < len(ids):
                piece = next(p for p in left if p[0] == at and p[3] == len(ids) and p[2] == crc32(ids[at : at + p[1]].tobytes()))
                left.remove(piece)
                at += piece[1]
            assert at == len(ids)
        assert not left
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return sum(sum(n for _, n in own) < window for own in filled.values())


def test_packing_keeps_every_token_once(spark):
    rows = _corpus()
    got = packing.pack(_docs(spark, rows), TOKENS, 256).collect()
    assert _checked(got, rows, 256) <= 1
    assert packing.pack(_docs(spark, []), TOKENS).count() == 0
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset) for r in packing.pack(_docs(spark, [(7, None, None)]), TOKENS).collect()] == [(7, 0, 1, 1, 0)]


def test_index_scores_are_bm25():
    rng = np.random.default_rng(1)
    texts = [np.append(rng.integers(2, 30, rng.integers(0, 40)), 1).astype(np.uint16) for _ in range(25)]
    n = {t: sum(t in x for x in texts) for t in range(30)}
    weight = np.array([max(0.0, np.log((25 - n[t] + 0.5) / (n[t] + 0.5))) for t in range(30)], np.float32)
    mean = sum(map(len, texts)) / 25
    index = packing.Index(texts, weight, mean)
    for i, q in enumerate(texts):
        want = []
        for x in texts:
            tf = {t: int((x[:-1] == t).sum()) for t in set(q[:-1].tolist())}
            want.append(sum(weight[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t, f in tf.items()))
        assert index.scores(index.terms[i]) == pytest.approx(want, rel=1e-5)


def test_a_seed_meets_its_nearest_documents_first():
    """Two topics in turn: windows hold one topic each; the rest of a cut document opens the next window, also across shards."""
    rng = np.random.default_rng(3)
    docs = [(i, np.append(rng.integers(2, 12, 30) + 20 * (i % 2), 1).astype(np.uint16)) for i in range(40)]
    weight = np.ones(60, np.float32)
    packer = packing.Packer(0, weight, 31.0, 62)
    pieces = [*packer.pack(docs[:21]), *packer.pack(docs[21:])]
    by_sequence = {}
    for doc_id, _, _, _, _, sequence, _ in pieces:
        by_sequence.setdefault(sequence, set()).add(doc_id % 2)
    assert all(len(topics) == 1 for topics in by_sequence.values()) and sum(p[2] for p in pieces) == 40 * 31
    long = packing.Packer(0, weight, 31.0, 62)
    assert [(p[0], p[1], p[2], p[5]) for p in long.pack([(1, np.ones(150, np.uint16)), (2, np.ones(36, np.uint16))])] == [(1, 0, 62, 0), (1, 62, 62, 1), (1, 124, 26, 2), (2, 0, 36, 2)]
