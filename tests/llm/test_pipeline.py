"""The pipeline's stages on the smallest table, each against what its own input demands."""

import hashlib
import math
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from leafgraph.llm import mixing, piece_codec, toxicity
from leafgraph.llm.store import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def without_exact_copies(docs):
    least = {}
    for doc, text in docs:
        key = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        least[key] = min(doc, least.get(key, doc))
    return set(least.values())


def without_near_copies(docs):
    sets = {doc: shingles(text) for doc, text in docs}
    label = {doc: doc for doc in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {k for k, v in label.items() if k == v}


def mixed(docs):
    """How often each document is taken."""
    sizes = {d.doc_id: len(re.findall("[^\x20\x09-\x0d]+", d.text or "")) for d in docs}
    of = Counter()
    for d in docs:
        of[d.source] += sizes[d.doc_id]
    names = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + [None] * (None in of)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(of.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * of[s]}
        target |= {s: 2.0 * of[s] if full else weight[s] * level for s in full or open_}
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    copies = {}
    for d in docs:
        rate = target[d.source] / of[d.source] if of[d.source] else 0.0
        draw = int(hashlib.md5(f"{mixing.SEED}:{d.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        copies[d.doc_id] = math.floor(rate) + (draw < rate - math.floor(rate))
    return Counter({k: n for k, n in copies.items() if n})


def test_stages(spark):
    """Each stage against a plain version, on its own input."""
    docs = table(spark, SF, "documents")
    label_rows = table(spark, SF, "labels")
    labels = {r.doc_id: r.toxic for r in label_rows.collect()}
    at = docs
    for name, stage_of in corpus_pipeline.STAGES:
        before, at = at, corpus_pipeline.stage(stage_of(spark, at, SF), name)
        rows = before.collect()
        pairs = [(r.doc_id, r.text) for r in rows]
        if name != "piece_codec":
            assert at.columns == docs.columns
            kept = Counter(r.doc_id for r in at.collect())
        if name == "toxicity":
            model = toxicity.train(before, label_rows)
            assert kept == Counter(d for d, t in pairs if model.score(t) < 0.5)
            gone = {d for d, _ in pairs} - set(kept)
            assert gone and not [d for d in gone if labels.get(d) == 0]
            assert 2 * len([d for d in gone if labels.get(d)]) >= sum(labels.values())
        if name == "exact_dedup":
            assert kept == Counter(without_exact_copies(pairs)) and len(kept) < len(rows)
        if name == "minhash_dedup":
            assert kept == Counter(without_near_copies(pairs)) and len(kept) < len(rows)
        if name == "source_mixing":
            assert kept == mixed(rows)
    spelled = {r.doc_id: r for r in at.collect()}
    assert at.columns == ["doc_id", "n_pieces", "pieces"] and at.count() == len(rows)
    for doc, text in pairs:
        assert piece_codec.decode_pieces_batch(np.array(spelled[doc].pieces), np.array([0, len(spelled[doc].pieces)])) == [text or ""]


def run_over(spark, folder, rows, labels, shape="doc_id long, text string, lang string, source string"):
    spark.createDataFrame(rows, shape).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return sorted(((r.doc_id, r.n_pieces) for r in corpus_pipeline.run(spark, str(folder)).collect()), key=str)


def test_empty_tables(spark, tmp_path):
    assert run_over(spark, tmp_path, [], []) == []


def test_awkward_tables(spark, tmp_path):
    """Nulls, empty texts, repeated rows and columns with clashing names."""
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, long, None, "a"), (2, long.replace("w7 ", "edit "), None, "a"), (3, long.replace(" w9", "\t w9"), None, "a"), (1, long, None, "a")]
    rows += [(4, None, None, None), (5, "", None, None), (None, "x y z", None, None), (6, "you are an idiot", None, "b"), (7, "plain words", None, "b")]
    names = "__id __text __kept __source __size __copies __toxicity decoded pieces".split()
    shape = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names)
    got = dict(run_over(spark, tmp_path, [(*r, *names) for r in rows], [], shape))
    assert {1, 7} <= set(got) and not {2, 3, 5, 6} & set(got) and got[1] > 200


def test_run_is_the_stages(spark):
    first, again = (sorted((r.doc_id, r.n_pieces) for r in corpus_pipeline.run(spark, SF).collect()) for _ in range(2))
    assert first == again and first


def test_pieces_are_decoded(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two"), (2, ""), (3, None), (None, "x")], "doc_id long, text string")
    got = {(r.doc_id, r.n_pieces, len(r.pieces)) for r in corpus_pipeline.encode_pieces(spark, docs, SF).collect()}
    assert {d for d, _, _ in got} == {1, 2, 3, None} and all(n == size for _, n, size in got)
    whole = piece_codec.round_trip
    monkeypatch.setattr(piece_codec, "round_trip", lambda docs: whole(docs).withColumn("lossless", F.expr("doc_id <> 2")))
    with pytest.raises(Exception, match="do not spell the text of document"):
        corpus_pipeline.encode_pieces(spark, docs, SF).collect()
