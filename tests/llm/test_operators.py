"""The training-data operators against brute force, on ordinary and on awkward tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from leafgraph.llm import (
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    piece_codec,
    queries,
    token_rollup,
    toxicity,
)
from leafgraph.llm.components import connected_components
from leafgraph.llm.shingles import shingle_sets
from pyspark.sql import functions as F

#: Names that the operators use themselves, or did.
CLASHING = (
    "leaf rep component place __id __text __other __other_text __kept __kept_id __doc __source __size __target __copies __copy __mix_source"
    " __mix_size __mix_target __mix_copies __mix_copy __toxicity decoded n row digest"
).split()
SHAPE = "doc_id long, text string, lang string, source string, " + ", ".join(f"{name} string" for name in CLASHING)


def table(spark, rows):
    """Documents with extra columns that have clashing names."""
    return spark.createDataFrame([(*r, *[None] * (4 - len(r)), *CLASHING) for r in rows], SHAPE)


def unharmed(spark, got, want_rows):
    """All columns are there, and the extra ones hold what they held."""
    assert got.columns == table(spark, []).columns
    rows = got.collect()
    assert all(tuple(r[4:]) == tuple(CLASHING) for r in rows) and len(rows) == want_rows


def words(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{i}" for i in rng.integers(0, 5000, n)]


def awkward():
    base = words(1, 300)
    near = [[*base[:k], f"edit{k}", *base[k + 1 :]] for k in range(0, 300, 7)]
    rows = [(10 * i, " ".join(near[i]), "en", f"s{i % 3}") for i in range(len(near))]
    rows += [(1000 + i, " ".join(base), "en", "hot") for i in range(60)]
    rows += [(2000 + i, " ".join(words(100 + i, 40)), None, None) for i in range(20)]
    rows += [(3000, None, None, "s1"), (3001, "", "de", "s1"), (3002, " \t\n", "de", None), (3003, "one two", "en", "s2"), (3004, "ONE\ttwo", "en", "s2")]
    rows += [(None, "one two", None, None), (None, None, None, None), (3003, "one two", "en", "s2"), (4000, "long " * 30000, "en", "s0")]
    return rows


def reach(nodes, links):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return {n: find(n) for n in nodes}


# ---- 8: exact ---------------------------------------------------------------------------------------------------------


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("leaves", [1, 16, 64])
def test_exact_groups(spark, leaves):
    rows = awkward()
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r[0])
    want = []
    for r in rows:
        ids = [i for i in groups[normal(r[1])] if i is not None]
        keep = min(ids) if ids else None
        want.append((r[0], keep, len(groups[normal(r[1])]), r[0] == keep, hashlib.sha256(normal(r[1]).encode()).hexdigest()))
    got = [tuple(x) for x in exact_dedup.exact_groups(table(spark, rows), leaves=leaves).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = exact_dedup.drop_exact_copies(table(spark, rows))
    unharmed(spark, kept, len(groups))
    unique = table(spark, [r for r in {r[0]: r for r in rows}.values() if r[0] is not None])
    unharmed(spark, exact_dedup.drop_exact_copies(unique), len({normal(r[1]) for r in rows}))


def entries(rows):
    return np.array([(digest + n.to_bytes(8, "big"), least, k) for digest, n, least, k in rows], dtype=exact_dedup.ENTRY)


def test_merging_keeps_apart_what_only_looks_equal():
    a, z = b"a" * 32, b"z" * 31 + b"\0"
    runs = [entries([(a, 5, 9, 1), (z, 7, 3, 1)]), entries([(a, 5, 4, 2), (a, 6, 1, 1)])]
    got = np.concatenate(list(exact_dedup.merge_runs(iter(sorted(runs, key=lambda r: r["key"][0])))))
    assert got.tolist() == entries([(a, 5, 4, 3), (a, 6, 1, 1), (z, 7, 3, 1)]).tolist()


@given(st.lists(st.lists(st.integers(0, 40), max_size=12), max_size=6), st.integers(1, 5))
@settings(max_examples=80, deadline=None)
def test_runs_merge_like_a_sum_over_all(runs, size):
    """Whatever the runs and the size of their blocks."""
    want, blocks = {}, []
    for number, run in enumerate(runs):
        run = sorted(set(run))
        for k in run:
            least, n = want.get(k, (10**6, 0))
            want[k] = (min(least, 100 * number + k), n + 1)
        rows = [(k.to_bytes(32, "big"), 1, 100 * number + k, 1) for k in run]
        blocks += [entries(rows[i : i + size]) for i in range(0, len(rows), size)]
    got = list(exact_dedup.merge_runs(iter(sorted(blocks, key=lambda b: b["key"][0]))))
    flat = np.concatenate([np.empty(0, exact_dedup.ENTRY), *got])
    assert [(int.from_bytes(e[0].ljust(40, b"\0")[:32], "big"), (int(e[1]), int(e[2]))) for e in flat.tolist()] == sorted(want.items())


# ---- 7: near ----------------------------------------------------------------------------------------------------------


def shingles(text, width=5):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(line_dedup._LOWER))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


@given(st.lists(st.text(alphabet="aAbÉ \n\x0b ", max_size=40), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_shingle_counts(texts):
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 5)] == [len(shingles(t)) for t in texts]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups(spark, percent):
    rows = awkward()
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = reach(ids, links)
    want = [(r[0], len(shingles(r[1])), root.get(r[0]), r[0] == root.get(r[0])) for r in rows]
    got = [tuple(x) for x in minhash_dedup.near_duplicate_groups(table(spark, rows), percent=percent).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_groups_that_no_head_links(spark, monkeypatch):
    """A chain whose ends are not alike, and chunks that are smaller than the buckets."""
    monkeypatch.setattr(minhash_dedup, "CHUNK", 4)
    monkeypatch.setattr(minhash_dedup, "CHUNK_ITEMS", 500)
    base = words(5, 200)
    rows = [(i, " ".join([f"e{j}" if j < 3 * i else w for j, w in enumerate(base)])) for i in range(30)]
    sets = {r[0]: shingles(r[1]) for r in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = reach(sets, links)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicate_groups(table(spark, rows), percent=85).collect()}
    assert got == root and len(set(root.values())) < 5


def test_keep_one_of_each_group(spark):
    rows = awkward()
    kept = minhash_dedup.keep_one_of_each_group(table(spark, rows))
    ids = [r.doc_id for r in kept.collect()]
    assert 1000 not in ids and 0 in ids and ids.count(None) == 2
    unharmed(spark, kept, len(ids))


def test_near_groups_of_long_texts(spark):
    """A document of a million words, a word of three million characters, and sets in chunks of few shingles."""
    long, giant = " ".join(f"w{i}" for i in range(1_000_000)), "x" * 3_000_000
    rows = [(1, long), (2, long.replace("w7 ", "edit ")), (3, giant), (4, giant + " y"), (5, giant.upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicate_groups(table(spark, rows)).collect()}
    assert got == {1: (999_996, 1), 2: (999_996, 1), 3: (1, 3), 4: (1, 4), 5: (1, 3)}


def test_words_are_hashed_alike_in_any_parts(monkeypatch):
    from leafgraph.llm import shingles as module

    texts = [b"the Quick brown\tfox " * 40, b"", b"x" * 5000 + b" a b c d e f", b"  lead " + b"Z" * 900 + b"\n" + b"y" * 12000]
    whole = shingle_sets(texts, 5)
    monkeypatch.setattr(module, "_CHUNK", 300)
    assert all(np.array_equal(a, b) for a, b in zip(whole, shingle_sets(texts, 5), strict=True))


def test_circulant_signatures_estimate_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 4000).astype(np.uint64))
    sig = minhash_dedup.signatures([a, np.sort(np.concatenate([a[: len(a) // 2], a[: len(a) // 2] + np.uint64(1)]))], 512)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.08
    assert (minhash_dedup.signatures([np.empty(0, np.uint64)], 4) == 0xFFFFFFFF).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (200, 200), (None, 5)] + [(500, 500 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 103)} == {100} and got[529] == 500 and 200 not in got


# ---- 4: lines ---------------------------------------------------------------------------------------------------------


def lines_by_hand(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(k := line_dedup.line_key(line)) >= 20:
                holders[k].add(-math.inf if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        me = -math.inf if doc is None else doc
        keep = [x for x in lines if len(holders[k := line_dedup.line_key(x)]) < 3 or max(holders[k]) == me]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_line_dedup(spark):
    shared, other = "This very line stands in all documents.", "  THIS very line stands in few documents.\t"
    rows = [(i, f"own line of document number {i}\n{shared}\nshort\n{other if i % 40 == 0 else ''}\n{shared.upper()}") for i in range(120)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (7, rows[7][1]), (None, f"{shared}\nx"), (503, "é" * 19 + "\n" + "é" * 20)]
    rows += [(600, "é" * 20 + "\n" + "É" * 20), (601, "é" * 20)]
    got = line_dedup.apply_keep_bitmaps(table(spark, rows), line_dedup.line_keep_bitmaps(table(spark, rows)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(lines_by_hand(rows), key=str)


def test_line_stream_over_any_borders():
    """One pass over each part, whatever the borders, and the border entries together decide like a pass over all."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    keys = sorted((int(k), 0, -int(d), int(p)) for k, d, p in {tuple(x) for x in rng.integers(0, (6, 9, 3), (150, 3))})
    rows = [(k, z, -d, 0, p) for k, z, d, p in keys]
    names = ("h1", "h2", "doc_id", "text_hash", "position")
    docs = defaultdict(set)
    for k, _, d, _, _ in rows:
        docs[k].add(d)
    want = {(d, p, k) for k, _, d, _, p in rows if len(docs[k]) >= 3 and d != max(docs[k])}
    for cuts in ([], [1, 2, 3], [10, 40, 41, 90], list(range(0, len(rows), 2))):
        # equal (key, document) pairs stay together, as the range partitioner keeps them
        cuts = [c for c in cuts if 0 < c < len(rows) and rows[c][:3] != rows[c - 1][:3]]
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            part = rows[a:b]
            batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*part[i : i + 3], strict=True)], names=names) for i in range(0, len(part), 3)]
            for batch in line_dedup._stream(3)(iter(batches)):
                out += batch.to_pylist()
        total, largest = Counter(), defaultdict(lambda: -1)
        for r in out:
            if r["kind"] == line_dedup._BORDER:
                total[r["h1"]] += r["docs"]
                largest[r["h1"]] = max(largest[r["h1"]], r["doc_id"])
        got = {(r["doc_id"], r["position"], r["h1"]) for r in out if r["kind"] == line_dedup._DROP}
        got |= {
            (r["doc_id"], r["position"], r["h1"])
            for r in out
            if r["kind"] == line_dedup._OPEN and total[r["h1"]] >= 3 and r["doc_id"] != largest[r["h1"]]
        }
        assert got == want


# ---- 2: licenses ------------------------------------------------------------------------------------------------------


def test_license_scan(spark):
    texts = {
        1: "Under the MIT-license, or Apache License, Version 2.0; CC BY NC cc by nc.",
        2: "under the  mit\nlicense under the mit license",
        3: "This work is licensed under the GNU General Public License, version 3.",
        4: "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and associated documentation files",
        5: None, 6: "", 7: "under the mit", 8: "é under THE mıt license",
    }
    rows = [*texts.items(), (2, texts[2]), (None, "cc by nc")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(table(spark, rows)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (16, 4, 0, 13, "apache-2,cc-by-nc,mit")
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 0, 4)
    assert (got[3].n_base, got[3].first_word, got[3].labels, got[3].score) == (0, None, "gpl-3", 1.0)
    assert got[4].labels == "mit-text" and 0.8 <= got[4].score < 1 and got[4].base_labels == ""
    assert all(got[i].labels == "" and got[i].n_base == 0 for i in (5, 6, 7, 8)) and got[None].base_labels == "cc-by-nc"
    assert got[5].n_words == 0 and got[7].score == 0.5


def test_license_scan_of_a_long_document(spark):
    """Work grows with the words of a document, not with their square."""
    n = 20_000
    rows = [(1, "Under the MIT License, you\nsee: CC-BY-NC étude 2 " * n, None, None), (2, "", None, None)]
    found = {r.doc_id: r for r in license_scan.scan_licenses(table(spark, rows)).collect()}
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].last_word) == (11 * n, 2 * n, 0, 11 * (n - 1) + 6)
    assert (found[1].base_labels, found[1].labels, found[1].score) == ("cc-by-nc,mit", "cc-by-nc,mit", 1.0)
    assert (found[2].n_words, found[2].n_base, found[2].first_word, found[2].labels) == (0, 0, None, "")


# ---- 9: mixing --------------------------------------------------------------------------------------------------------


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 40)), None, [f"s{i % 7}", "é", "z", None][i % 4] if i % 3 else "hot") for i in range(3000)]
    rows += [(9000, None, None, "empty"), (None, "a b", None, "s1"), (5, "w w", None, "hot")]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = targets_by_hand(dict(sizes))
    plan = mixing.mix_plan(table(spark, rows)).collect()
    taken, source = Counter(), {r[0]: r[3] for r in rows}
    for r in plan:
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6 or r.doc_id in (5, None)
        assert 0 <= r.copies <= 2
        taken[source[r.doc_id]] += r["size"] * r.copies
    assert all(abs(taken[s] - want[s]) <= 0.25 * want[s] + 30 for s in want)
    again = sorted(tuple(x) for x in mixing.mix_plan(table(spark, rows).repartition(3)).na.fill(-1).collect())
    assert again == sorted(tuple(x) for x in mixing.mix_plan(table(spark, rows)).na.fill(-1).collect())
    mixed = mixing.mix(table(spark, rows))
    unharmed(spark, mixed, sum(r.copies for r in plan))


def test_mixing_without_words(spark):
    assert [r.copies for r in mixing.mix_plan(table(spark, [(1, None, None, "a"), (2, "", None, None)])).collect()] == [0, 0]


# ---- 3: vectors -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("cell", "chunk"), [(8192, 8192), (40, 32)])
def test_vector_groups(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    x = np.concatenate([base, base[:30] + rng.normal(size=(30, 8)) * 0.2, np.repeat(base[:1], 50, axis=0), base[:30] * 3, base[1] + rng.normal(size=(80, 8)) * 0.1])
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] + [0.0] * 6), (904, [float("nan")] + [1.0] * 7), (905, [float("inf")] * 8)]
    odd += [(906, [1.0, 2.0]), (907, [2.0, 4.0]), (0, rows[0][1]), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in embedding_dedup.vector_groups(frame, cell=cell, sample=100).collect()]
    every = [*rows, *odd]
    fit = {i for i, (k, v) in enumerate(every) if k is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links, pairs = Counter(), []
    for i in fit:
        for j in fit:
            a, b = every[i][1], every[j][1]
            if i < j and len(a) == len(b):
                a, b = np.array(a), np.array(b)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((every[i][0], every[j][0]))
    root = reach([v for v, _ in every if v is not None], pairs) | {None: None}
    want = [(v, links[i], root[v], root[v] == v) for i, (v, _) in enumerate(every)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bounds_let_every_link_through():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 40))
    x[100:200] = x[:100] + rng.normal(size=(100, 40)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for leading in (embedding_dedup.leading_components(x), np.eye(40)[:, :3]):
        low = embedding_dedup._bounding(x, leading)
        assert (low @ low.T >= x @ x.T - 1e-5).all()
        found = set(zip(*(k.tolist() for k in embedding_dedup.linked(x, x, low, low, 0.9)), strict=True))
        assert found == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= 0.9)), strict=True)) and len(found) > 300


def test_vectors_of_many_components(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(20, 3000))
    rows = [(i, [float(v) for v in base[i // 2] + rng.normal(size=3000) * 0.05]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.vector_groups(frame).collect()) == [(i, 1, i // 2 * 2) for i in range(40)]


# ---- 1: toxicity ------------------------------------------------------------------------------------------------------


def test_the_grammar_looks_at_clauses():
    model = toxicity.Model()
    plain, negated, reported, clean = (
        model.score(t) for t in ("You are an idiot.", "You are not an idiot.", "He said you are an idiot.", "You are kind.")
    )
    assert plain > 0.5 > max(negated, reported) > clean
    assert model.score("I will kill you") > 0.5 > model.score("they kill time") and model.score(None) == model.score("") == clean
    assert model.score("Not today. You idiot!") > 0.5  # a negation ends with its clause
    assert model.score("idiot that you are") > 0.5 > model.score("idiot")
    assert max(model.score(t) for t in ("the word idiot has six letters", "idiot is a word", "Le trottel", "the idiot")) < 0.5
    assert min(model.score(t) for t in ("that was a stupid idiot", "idiot moron", "tu es un crétin", "du bist ein Trottel")) > 0.5


def by_hand(symbols):
    """What each insult or threat of a clause matches, by looking around it."""
    out = []
    for i, s in enumerate(symbols):
        if s not in "IT":
            continue
        back = lambda kind, reach: kind in symbols[max(0, i - reach) : i]  # noqa: B023, E731
        ahead = lambda kind, reach: kind in symbols[i + 1 : i + 1 + reach]  # noqa: B023, E731
        aimed = back("P", 4) or ahead("P", 4)
        if s == "T" and not aimed:
            continue
        kinds = [
            ("negated", back("N", 3)), ("reported", "R" in symbols[:i]), ("mentioned", back("M", 2) or ahead("M", 3)), ("aimed", aimed),
            ("predicated", back("C", 3)), ("piled", s == "I" and symbols.count("I") > 1), ("described", back("D", 2)), ("bare", True),
        ]
        pattern = next(name for name, holds in kinds if holds)
        out.append((i, "threat" if s == "T" and pattern == "aimed" else pattern))
    return out


@given(st.lists(st.sampled_from("ITPCDMNRoooo"), max_size=14))
@settings(max_examples=400, deadline=None)
def test_transducers_match_what_stands_around(symbols):
    assert list(toxicity.matches(symbols)) == by_hand(symbols)


def test_what_counts_is_learned_from_clauses(spark):
    """The same words make a text toxic in one order and not in another, if the labels say so."""
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(400):
        filler = [re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], w) for w in words(900 + i, 30)]
        insult = ["idiot", "moron", "loser", "jerk"][i % 4]
        at = int(rng.integers(0, 20))
        if i % 2:
            text = [*filler[:at], "you", "are", "an", insult, *filler[at:]]
        else:
            text = ["you", "are", "an", *filler, insult]
        rows.append((i, " ".join(text)))
        labels.append((i, i % 2))
    model = toxicity.train(table(spark, rows[:300]), spark.createDataFrame(labels[:300], "doc_id long, toxic int"))
    assert [i for i, t in rows[300:] if (model.score(t) >= 0.5) != bool(i % 2)] == []
    assert max(model.score(t) for t in ("idiot", "the idiot", "the word idiot has six letters", "you are not an idiot")) < 0.5
    shuffled = 0
    for i, t in rows[301::2]:
        shuffled += model.score(" ".join(np.random.default_rng(i).permutation(t.split()))) >= 0.5
    assert shuffled <= 20  # of 50: chance puts a target near the insult now and then


def test_toxicity_of_long_texts():
    model = toxicity.Model()
    filler = "the words of an ordinary sentence go on and on, " * 100_000
    assert model.score(filler) == model.score("") and model.score(filler + "you idiot") > 0.5
    assert model.score("on " * 1_000_000 + "you idiot " + "on " * 1_000_000) > 0.5


def small_folder(spark, tmp_path, rows, labels=()):
    spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def crc(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def test_op1_as_registered(spark, tmp_path):
    """Folds, scores and predictions of the query, with the model that the labels outside the fold give."""
    rows = [(i, f"word{i % 7} you are an idiot" if i % 5 == 0 else f"word{i % 7} and so on") for i in range(300)] + [(900, None), (901, ""), (None, "x")]
    labels = [(i, int(i % 5 == 0)) for i in range(300)]
    got = queries.op1_toxicity(spark, small_folder(spark, tmp_path, rows, labels)).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    known = [x for x in labels if crc(x[0], 5)]
    model = toxicity.train(table(spark, rows), spark.createDataFrame(known, "doc_id long, toxic int"))
    texts = dict(rows)
    for r in got:
        assert r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5)
        assert abs(r.score - model.score(texts[r.doc_id])) < 1e-9 and 0 <= r.score <= 1
    assert all(r.predicted == int(r.doc_id is not None and r.doc_id < 300 and r.doc_id % 5 == 0) for r in got)


def test_toxicity_learns_new_words(spark):
    rng = np.random.default_rng(4)
    bad = ["grumwort", "zarkine", "zarkom", "zarkuta", "zarkelu", "zarkopi"]
    rows = []
    for i in range(600):
        text = words(i + 1, 40)
        if i % 6 == 0:
            text[int(rng.integers(0, 39))] = bad[int(rng.integers(0, len(bad)))]
            text[int(rng.integers(0, 39))] = "grumwort"
        rows.append((i, " ".join(re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], w) for w in text)))
    docs = table(spark, [*rows, (9000, None), (9001, ""), (None, "grumwort")])
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    wrong = [i for i, t in rows[400:] if (model.score(t) >= 0.5) != (i % 6 == 0)]
    assert not wrong and model.score("zarkblub") < 1
    kept = toxicity.drop_toxic(docs, model)
    assert {9000, 9001} <= {r.doc_id for r in kept.collect()}
    unharmed(spark, kept, sum(model.score(r.text) < 0.5 for r in docs.collect()))


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(table(spark, [(1, "x")]), none).score("you idiot") > 0.5


# ---- 5: language ------------------------------------------------------------------------------------------------------


def test_languages():
    en = ["the cat sat on the mat and looked at the other one", "what is it that they would like to have there", "this is the house that they built with their own hands"]
    de = ["die Katze saß auf der Matte und sah die andere an", "was ist es denn das sie gerne hätten", "das ist das Haus das sie mit eigenen Händen gebaut haben"]
    ru = ["это дом который они построили сами", "что они хотели бы там иметь"]
    model = language_id.fit([(t, "en") for t in en] * 5 + [(t, "de") for t in de] * 5 + [(t, "ru") for t in ru] * 5)
    mixed = "They looked at the other house there. Они хотели дом. Das ist die andere Matte und das Haus"
    spans = language_id.label_spans([mixed, "", None, "12 !", "ελληνικά", "это"], model)
    assert [s[2] for s in spans[0]] == ["en", "ru", "de"] and [mixed[s[0] : s[1]] for s in spans[0]][1] == "Они хотели дом"
    assert spans[1] == spans[2] == spans[3] == [] and len(spans[4]) == 1 and spans[5][0][2] == "ru"
    assert language_id.label_spans(["x"], language_id.fit([])) == [[]]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    lengths = np.array([7, 0, 1, 5])
    scores = rng.normal(size=(13, 3)).astype(np.float32) * 2
    path = language_id._viterbi(scores, np.array([0, 7, 7, 8]), lengths, 1.5)
    at = 0
    for n in lengths:
        best = {(): 0.0}
        for t in range(n):
            best = {(*p, k): v + float(scores[at + t, k]) - (1.5 if p and p[-1] != k else 0) for p, v in best.items() for k in range(3)}
        assert tuple(path[at : at + n].tolist()) == max(best, key=best.get)
        at += n


def test_main_language(spark):
    model = language_id.fit([("the and of with that", "en"), ("der und die das mit", "de")])
    docs = table(spark, [(1, "the and of"), (2, None), (3, "!!"), (None, "der die das"), (1, "the and of")])
    lang, share = language_id.main_language(F.col("spans"))
    got = sorted(((r.doc_id, r.lang, r.share) for r in language_id.label_languages(docs, model).select("doc_id", lang.alias("lang"), share.alias("share")).collect()), key=str)
    assert got == sorted([(1, "en", 1.0), (1, "en", 1.0), (2, "und", 0.0), (3, "und", 0.0), (None, "de", 1.0)], key=str)


def test_long_texts_are_labelled_like_short_ones(monkeypatch):
    """In stretches, word by word or side by side, and of a million words."""
    model = language_id.fit([("the and of with that this", "en"), ("der und die das mit nicht", "de")] * 3)
    rng = np.random.default_rng(7)
    text = "".join(("the and of with " if rng.random() < 0.5 else "der und die das, ") * int(rng.integers(1, 30)) for _ in range(60))
    whole = language_id.label_spans([text, "the", None], model)
    monkeypatch.setattr(language_id, "LONG_TEXT", 3)
    assert language_id.label_spans([text, "the", None], model) == whole
    monkeypatch.setattr(language_id, "_BATCH", 100)
    monkeypatch.setattr(language_id, "_GRAMS", 37)
    assert language_id.label_spans([text, "the", None], model) == whole and len(whole[0]) > 10
    monkeypatch.undo()
    spans = language_id.label_spans(["the and " * 500_000 + "der und " * 500_000, "z" * 3_000_000], model)
    assert [s[2] for s in spans[0]] == ["en", "de"] and spans[0][1][0] == 4_000_000 and spans[1][0][1] == 3_000_000


def test_scripts_and_ties():
    model = language_id.fit([("это дом", "ru"), ("the house", "en"), ("das haus", "de")])
    assert all(model.writes[language_id.SCRIPTS.index("cyrillic")] == [name == "ru" for name in model.languages])
    points, _, script, _ = language_id._points(["aж中\U00020000"])
    assert [language_id.SCRIPTS[s] for s in script[:3]] == ["latin", "cyrillic", "han"] and points[3] == 0x20000


def test_ties_go_to_the_first_name(spark):
    spans = spark.createDataFrame([(1, [(0, 2, "fr", 2), (3, 5, "de", 2)]), (2, [])], f"id int, spans {language_id.SPANS}")
    lang, share = language_id.main_language(F.col("spans"))
    assert [tuple(r) for r in spans.orderBy("id").select(lang, share).collect()] == [("de", 0.5), ("und", 0.0)]


def test_training_counts_on_executors_like_fitting(spark):
    rows = [(i, t, lang, None) for i, (t, lang) in enumerate([("the house of cards", "en"), ("das haus", "de"), ("the end", "en"), (None, "en"), ("x", None)])]
    trained, fitted = language_id.train(table(spark, rows)), language_id.fit([(r[1], r[2]) for r in rows[:3]])
    assert trained.languages == fitted.languages and np.allclose(trained.table, fitted.table) and (trained.writes == fitted.writes).all()


def test_op5_as_registered(spark, tmp_path):
    en, de = "the cat sat on the mat and looked at that other one", "die katze saß auf der matte und sah die andere an"
    rows = [(i, [en, de][i % 2] + f" {i}", ["en", "de"][i % 2], None) for i in range(60)] + [(100, None, "en", None), (101, "12 !", None, None), (None, en, None, None)]
    got = {r.doc_id: r for r in queries.op5_language_id(spark, small_folder(spark, tmp_path, rows)).collect()}
    assert len(got) == len(rows) and all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == ["en", "de"][i % 2] for i in range(60)) and got[None].lang_pred == "en"
    assert (got[100].lang_pred, got[100].score, got[101].lang_pred) == ("und", 0.0, "und")


# ---- 6: pieces --------------------------------------------------------------------------------------------------------

ODD = ["", "a", "  a  b ", "▁x ▁▁", "\n\n a\tb\r\n", "日本語 текст \U0001f642\U0001f642 x", " " * 300, "ab" * 400, "é́ \U0001d518", "\0\x01", "word " * 500]


def decoded(pieces):
    return piece_codec.decode_pieces_batch(np.concatenate(pieces), np.concatenate(([0], np.cumsum([len(p) for p in pieces]))))


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.7, 1.0])
def test_pieces_are_lossless(dropout):
    assert decoded(piece_codec.encode_batch(ODD, np.arange(len(ODD)), dropout=dropout)) == ODD


@given(st.lists(st.text(max_size=60), min_size=1, max_size=5), st.integers(0, 2**62))
@settings(max_examples=60, deadline=None)
def test_any_text_is_lossless(texts, key):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert decoded(piece_codec.encode_batch(texts, np.full(len(texts), key))) == texts


def test_pieces_without_dropout_are_the_models_own():
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=piece_codec.DEFAULT_MODEL)
    texts = [t for t in ODD if "▁" not in t] + ["The quick brown fox, jumped over it!"]
    assert [p.tolist() for p in piece_codec.encode_batch(texts, np.zeros(len(texts)), dropout=0.0)] == [library.encode(t) for t in texts]


def test_dropout_is_keyed(monkeypatch):
    text = "segmentation of several ordinary sentences varies with the key " * 4
    one = [p.tolist() for p in piece_codec.encode_batch([text] * 4, np.array([1, 2, 3, 1]))]
    assert one[0] == one[3] and len({tuple(x) for x in one}) == 3
    assert piece_codec.encode_batch(["other", text], np.array([9, 2]))[1].tolist() == one[1]  # in any batch
    assert piece_codec.encode_batch([text], np.array([1]), seed=7)[0].tolist() != one[0]
    monkeypatch.setattr(piece_codec, "LONG", 0)  # every stretch by its own heap
    assert [p.tolist() for p in piece_codec.encode_batch([text] * 4, np.array([1, 2, 3, 1]))] == one


def pieces_by_hand(text, key, dropout, seed=piece_codec.SEED):
    """The whole text as one list of symbols, all candidates looked at for each merge."""
    p, mix = piece_codec.load(), piece_codec.mix64
    limit = np.uint64(min(int(dropout * 2.0**64), (1 << 64) - 1))
    named = mix(mix(np.array([key]).view(np.uint64) ^ np.uint64(seed)))
    symbols = []
    for i, c in enumerate(" " + text):
        known = p.space if c == " " else -1 if c == "▁" else int(p.of_point[ord(c)]) if ord(c) < 0x10000 else p.of_far_point.get(ord(c), -1)
        symbols.append((i, i + 1, known, c))
    while True:
        best = None
        for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)):
            found = p.pairs.get(a[2] << 16 | b[2]) if a[2] >= 0 and b[2] >= 0 else None
            if found and not piece_codec._skipped(named, *(np.array([x]) for x in (a[0], a[1], b[1])), limit)[0]:
                best = min(best or (found[0], k), (found[0], k))
        if best is None:
            break
        a, b = symbols[best[1] : best[1] + 2]
        symbols[best[1] : best[1] + 2] = [(a[0], b[1], p.pairs[a[2] << 16 | b[2]][1], "")]
    out = []
    for _, _, piece, c in symbols:
        out += [piece] if piece >= 0 else p.byte_piece[list(c.encode())].tolist()
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_dropout_like_an_agenda_by_hand(dropout, monkeypatch):
    texts = ["The quick brown fox, jumped  over it!", "日本語 ▁ текст \U0001f642 internationalization", "aaaa" * 20 + " banana bandana", " \n x"]
    want = [pieces_by_hand(t, 7 + i, dropout) for i, t in enumerate(texts)]
    assert [x.tolist() for x in piece_codec.encode_batch(texts, np.arange(7, 11), dropout=dropout)] == want
    monkeypatch.setattr(piece_codec, "LONG", 4)
    monkeypatch.setattr(piece_codec, "_BATCH", 8)  # in parts
    assert [x.tolist() for x in piece_codec.encode_batch(texts, np.arange(7, 11), dropout=dropout)] == want


def test_pieces_of_long_texts():
    texts = ["some ordinary words, " * 150_000, "ab" * 200_000, " " * 100_000]
    assert decoded(piece_codec.encode_batch(texts, np.arange(3))) == texts


def test_pieces_of_a_table(spark):
    docs = table(spark, awkward())
    encoded = piece_codec.encode(docs)
    got = piece_codec.decode(encoded).collect()
    assert len(got) == docs.count() and all(r.decoded == (r.text or "") for r in got)
    again = piece_codec.decode(encoded.selectExpr("doc_id", "'old' as Decoded", "pieces", "text"))
    assert again.columns == ["doc_id", "pieces", "text", "decoded"] and all(r.decoded == (r.text or "") for r in again.collect())
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, pieces array<int>")
    assert [r.decoded for r in piece_codec.decode(none).collect()] == ["", ""]


def test_a_wrong_decoder_is_noticed(spark, monkeypatch):
    rows = [(1, "one two"), (2, "")]
    assert [r.lossless for r in piece_codec.round_trip(table(spark, rows)).collect()] == [True, True]
    batch = spark.createDataFrame(rows, "doc_id long, text string").toArrow().to_batches()[0]
    lists, texts = piece_codec._encoded(batch, piece_codec.DEFAULT_MODEL, 0.1, 1)
    broken = lists.values.to_numpy().copy()
    broken[1] = broken[0]
    assert piece_codec.decode_pieces_batch(broken, lists.offsets.to_numpy()) != texts


def test_op6_as_registered(spark, tmp_path):
    rows = [(1, "one two three"), (2, None), (3, "é\U0001f642"), (None, "x")]
    got = {r.doc_id: r for r in queries.op6_piece_codec(spark, small_folder(spark, tmp_path, rows)).collect()}
    for doc, text in rows:
        assert got[doc].lossless and got[doc].n_pieces == len(got[doc].pieces)
        assert got[doc].pieces == (pieces_by_hand(text, doc or 0, piece_codec.DROPOUT) if text else [])


# ---- 10: token counts -------------------------------------------------------------------------------------------------


def test_rollup(spark, tmp_path):
    counts = spark.createDataFrame([("a", "en", 5, 6), ("a", "en", 7, 7), ("b", None, 2, 1), (None, None, 1, 1)], "source string, lang string, t long, u long")
    rollup = token_rollup.Rollup(spark, f"file://{tmp_path}/rollup")
    assert rollup.totals().count() == 0
    assert rollup.commit("first", token_rollup.inserts(counts, "v1", "t")) and not rollup.commit("first", token_rollup.inserts(counts, "v1", "t"))

    def totals():
        return sorted(((r.source, r.lang, r.docs, r.tokens) for r in rollup.totals().collect()), key=str)

    assert totals() == sorted([("a", "en", 2, 12), ("b", None, 1, 2), (None, None, 1, 1)], key=str)
    rollup.commit("revised", token_rollup.revisions(counts, "v1", "t", "u"))
    rollup.commit("gone", token_rollup.deletes(counts.where("source = 'b'"), "v1", "u"))
    want = sorted([("a", "en", 2, 13), (None, None, 1, 1)], key=str)
    assert totals() == want
    rollup.fold()
    assert totals() == want and len(rollup.batches()) == 1
    assert not rollup.commit("first", token_rollup.inserts(counts, "v1", "t"))
    rollup.commit("empty", token_rollup.inserts(counts.limit(0), "v1", "t"))
    rollup.fold()
    assert totals() == want and not rollup.commit("gone", token_rollup.inserts(counts, "v1", "t"))
    with pytest.raises(ValueError):
        rollup.commit("a/b", token_rollup.inserts(counts, "v1", "t"))


def test_a_fold_that_fails_loses_nothing(spark, tmp_path, monkeypatch):
    counts = spark.createDataFrame([("a", "en", 5)], "source string, lang string, t long")
    rollup = token_rollup.Rollup(spark, f"file://{tmp_path}/rollup")
    for name in ("one", "two"):
        rollup.commit(name, token_rollup.inserts(counts, "v1", "t"))
    monkeypatch.setattr(rollup, "_publish", lambda name, sums: False)
    assert not rollup.fold() and [(r.docs, r.tokens) for r in rollup.totals().collect()] == [(2, 10)]
    monkeypatch.undo()
    real = rollup._publish

    def meanwhile(name, sums):
        if name.startswith("fold-"):
            assert not rollup.fold()  # one at a time
            rollup.commit("three", token_rollup.inserts(counts, "v1", "t"))
        return real(name, sums)

    monkeypatch.setattr(rollup, "_publish", meanwhile)
    assert rollup.fold() and len(rollup.batches()) == 2
    assert [(r.docs, r.tokens) for r in rollup.totals().collect()] == [(3, 15)]
    rollup._files().createNewFile(rollup._path(f"{rollup.root}/fold.lock"))
    assert not rollup.fold() and rollup.fold(break_lock=True) and [(r.docs, r.tokens) for r in rollup.totals().collect()] == [(3, 15)]


@given(st.lists(st.sampled_from(["word", " ", "x's", "\n" * 30, " " * 21, " \n" * 15, "\x1c" * 25, "7", "!", "\u3000" * 22]), max_size=6))
@settings(max_examples=150, deadline=None)
def test_long_runs_of_white_space_count_alike(parts):
    text, run = "".join(parts), token_rollup._RUN
    try:
        token_rollup._RUN = re.compile(run.pattern.replace("10000", "20"))
        assert token_rollup.n_tokens(text) == len(token_rollup._encodings(token_rollup.DEFAULT_RANKS)[0].encode_ordinary(text))
    finally:
        token_rollup._RUN = run


@pytest.mark.parametrize("n", [1_000_000, 10_000_000])
def test_texts_of_white_space(n):
    assert token_rollup.n_tokens(" " * n) == n and token_rollup.n_tokens("\n" * n + "x") > 0


def test_op10_as_registered(spark, tmp_path):
    rows = [(1, "hello world", "en", "a"), (2, "hello  there, you", "en", "a"), (3, None, "en", "b"), (4, "x y", None, None), (5, "", "de", "b"), (5, "", "de", "b")]
    got = {tuple(r) for r in queries.op10_token_rollup(spark, small_folder(spark, tmp_path, rows)).collect()}
    encode = token_rollup._encodings(token_rollup.DEFAULT_RANKS)[0].encode_ordinary
    want = Counter()
    for _, text, lang, source in rows:
        for version, n in (("words-1", len((text or "").split())), ("byte_bpe_50k", len(encode(text or "")))):
            want[source, lang, version, "docs"] += 1
            want[source, lang, version, "tokens"] += n
    assert got == {(s, g, v, want[s, g, v, "docs"], want[s, g, v, "tokens"]) for s, g, v, _ in want}
    assert queries.op10_token_rollup(spark, small_folder(spark, tmp_path / "none", [])).count() == 0


def test_token_counts(spark):
    docs = table(spark, [(1, "hello world"), (2, None), (3, "")])
    assert [r.n for r in docs.select(token_rollup.count_tokens(F.col("text")).alias("n")).collect()] == [2, 0, 0]


# ---- empty tables -----------------------------------------------------------------------------------------------------


def test_empty_tables(spark):
    docs = table(spark, [])
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    results = [
        exact_dedup.exact_groups(docs), exact_dedup.drop_exact_copies(docs), minhash_dedup.near_duplicate_groups(docs),
        line_dedup.apply_keep_bitmaps(docs, line_dedup.line_keep_bitmaps(docs)), license_scan.scan_licenses(docs), mixing.mix_plan(docs), mixing.mix(docs),
        embedding_dedup.vector_groups(vectors), toxicity.drop_toxic(docs, toxicity.train(docs, labels)),
        language_id.label_languages(docs, language_id.train(docs)), piece_codec.decode(piece_codec.encode(docs)),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_folds(spark):
    from leafgraph.llm.queries import _fold

    got = spark.range(200).select("id", _fold(F.col("id"), 5).alias("a"), _fold(F.col("id"), 3).alias("b")).collect()
    assert all((r.a, r.b) == (zlib.crc32(str(r.id).encode()) % 5, zlib.crc32(str(r.id).encode()) % 3) for r in got)
