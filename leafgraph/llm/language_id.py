"""Language identification of mixed text: script ranges, per-word scores, Viterbi with a switching penalty.

Words are maximal runs of letters.  The script of a word, read off its code point ranges, leaves the languages that write
in it; character pairs and triples score those; and the best path through the words, paying for each switch of language,
labels spans.  All per-character work is done on arrays of code points, a stretch of bounded length at a time.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.store import arrow_batches, small_side

#: Documents of each language that the model is fitted on.
MAX_PER_LANGUAGE = 1000
BITS = 17
SWITCH = 8.0
#: What a word of another script costs a language.
FOREIGN = 40.0
#: A language uses a script that holds this share of its letters.
SCRIPT_SHARE = 0.02
#: Characters that are worked on at once, and positions whose scores are held at once.  Only a word can be longer.
_BATCH = 1 << 19
_GRAMS = 1 << 17
#: Texts of more words go word by word, the others side by side in groups of at most so many cells.
LONG_TEXT = 4096
_CELLS = 1 << 17

# First and last code points of script ranges, by script (Unicode blocks).
SCRIPT_RANGES = [
    (0x0041, 0x024F, "latin"), (0x1E00, 0x1EFF, "latin"), (0x0370, 0x03FF, "greek"), (0x1F00, 0x1FFF, "greek"),
    (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"), (0x0600, 0x06FF, "arabic"),
    (0x0750, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"), (0x0B80, 0x0BFF, "tamil"),
    (0x0E00, 0x0E7F, "thai"), (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0xAC00, 0xD7AF, "hangul"),
    (0x3040, 0x30FF, "kana"), (0x3400, 0x4DBF, "han"), (0x4E00, 0x9FFF, "han"),
]
SCRIPTS = ["other", *dict.fromkeys(name for *_, name in SCRIPT_RANGES)]

_tables: dict[str, np.ndarray] = {}


def _bmp() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point up to 0xFFFF: its lower case, whether it is a letter, its script."""
    if not _tables:
        chars = [chr(c) for c in range(0x10000)]
        _tables["letter"] = np.array([c.isalpha() for c in chars])
        _tables["lower"] = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], dtype=np.uint32)
        script = np.zeros(0x10000, dtype=np.uint8)
        for first, last, name in SCRIPT_RANGES:
            script[first : last + 1] = SCRIPTS.index(name)
        _tables["script"] = script
    return _tables["lower"], _tables["letter"], _tables["script"]


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of the texts, each followed by a zero; letters; scripts; and where each text begins."""
    lower, letter, script = _bmp()
    raw = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    far = raw > 0xFFFF
    low = np.where(far, 0, raw)
    is_letter, scripts, points = letter[low], script[low], lower[low]
    if far.any():
        astral = np.unique(raw[far])
        letters = astral[[unicodedata.category(chr(c))[0] == "L" for c in astral.tolist()]]
        is_letter = np.where(far, np.isin(raw, letters), is_letter)
        points = np.where(far, raw, points)
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return points.astype(np.uint32), is_letter, scripts, begin


def _grams(points: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that end a pair or triple of a word (or its end), and the hashed pair and triple there."""
    z = np.where(letter, points, 0).astype(np.uint32)
    z1 = np.concatenate(([0], z[:-1])).astype(np.uint32)
    z2 = np.where(z1 == 0, 0, np.concatenate(([0], z1[:-1]))).astype(np.uint32)
    at = np.flatnonzero((z != 0) | (z1 != 0))
    a, b, c = z[at], z1[at], z2[at]
    pair = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA6B)
    triple = pair * np.uint32(0xC2B2AE35) + c * np.uint32(0x27D4EB2F) + np.uint32(0x165667B1)
    pair ^= pair >> np.uint32(15)
    triple ^= triple >> np.uint32(15)
    shift = np.uint32(32 - BITS)
    return at, (pair * np.uint32(0x2C1B3C6D)) >> shift, (triple * np.uint32(0x297A2D39)) >> shift


@dataclass
class Model:
    languages: list[str]  # the most frequent first
    table: np.ndarray  # pairs, then triples: (2 << BITS, languages)
    writes: np.ndarray  # (scripts, languages): whether the language uses the script


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often each pair and triple, and then each script, occurs in the texts: the ones that do, and their counts."""
    counts = np.zeros((2 << BITS) + len(SCRIPTS), dtype=np.int64)
    for text in texts:
        for _, stretch in _stretches(text):
            points, letter, script, _ = _points([stretch])
            _, pair, triple = _grams(points, letter)
            for at, found, most in ((0, pair, 1 << BITS), (1 << BITS, triple, 1 << BITS), (2 << BITS, script[letter], len(SCRIPTS))):
                counts[at : at + most] += np.bincount(found, minlength=most)
    some = np.flatnonzero(counts)
    return some, counts[some]


def _model(sizes: dict[str, int], counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model from documents and counts by language."""
    languages = sorted(counts, key=lambda x: (-sizes[x], x))
    if not languages:
        return Model([], np.zeros((2 << BITS, 0), dtype=np.float32), np.zeros((len(SCRIPTS), 0), dtype=bool))
    full = np.zeros(((2 << BITS) + len(SCRIPTS), len(languages)))
    for k, language in enumerate(languages):
        full[counts[language][0], k] = counts[language][1]
    grams, scripts = full[: 2 << BITS], full[2 << BITS :]
    table = np.zeros_like(grams)
    for half in (slice(0, 1 << BITS), slice(1 << BITS, 2 << BITS)):
        kinds = max(1, int((grams[half].sum(axis=1) > 0).sum()))
        table[half] = np.log((grams[half] + 0.5) / (grams[half].sum(axis=0) + 0.5 * kinds))
    table -= table.mean(axis=1, keepdims=True)
    writes = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, table.astype(np.float32), writes & (scripts > 0))


def fit(rows: list[tuple[str, str]]) -> Model:
    """Fit on ``(text, language)`` rows."""
    by: dict[str, list[str]] = {}
    for text, language in rows:
        by.setdefault(language, []).append(text or "")
    return _model({k: len(v) for k, v in by.items()}, {k: _counted(v) for k, v in by.items()})


def train(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE) -> Model:
    """Fit on about ``max_per_language`` documents of each non-null ``lang``, taken by a hash of the id.

    Executors count pairs and triples; the driver gets sums only, at most 2**18 a language, however long texts are.  Null
    texts and languages are left out, repeated rows count as often as they stand there, and an empty table gives a model
    without languages.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    known = docs.where("lang is not null and text is not null").select("text", "lang", F.xxhash64("doc_id", F.lit("language")).alias("h"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    drawn = known.join(small_side(sizes), "lang").where(F.pmod("h", F.lit(1 << 30)) < F.least(F.lit(1.0), max_per_language / F.col("n")) * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                by.setdefault(language, []).append(text)
            for language, texts in by.items():
                some, counts = _counted(texts)
                columns = [pa.array([language] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts)]
                yield pa.record_batch(columns, names=("lang", "gram", "n"))

    sums = drawn.select("text", "lang").mapInArrow(count, "lang string, gram int, n long")
    sums = sums.groupBy("lang", "gram").agg(F.sum("n").alias("n")).groupBy("lang")
    sums = sums.agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts"))  # 2**18 entries at most
    counts = {r["lang"]: (np.array(r["grams"], dtype=np.int64), np.array(r["counts"], dtype=np.int64)) for r in sums.toLocalIterator()}
    return _model({r["lang"]: r["n"] for r in sizes.toLocalIterator()}, counts)


def _viterbi(scores: np.ndarray, first: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word.  Texts of similar length are worked through side by side, word by word."""
    n = scores.shape[1]
    path = np.zeros(len(scores), dtype=np.int16)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        group = order[at : at + max(1, min(256, _CELLS // int(lengths[order[at]])))]
        at += len(group)
        size, begin = lengths[group], first[group]
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # texts longer than t: a leading run
        stays = np.zeros((size[0], len(group), n), dtype=bool)
        leads = np.zeros((size[0], len(group)), dtype=np.int16)
        value = scores[begin].astype(np.float64)
        for t in range(1, size[0]):
            a = active[t]
            v = value[:a]
            lead = v.argmax(axis=1)
            moved = v[np.arange(a), lead] - switch
            stay = v >= moved[:, None]
            stays[t, :a], leads[t, :a] = stay, lead
            value[:a] = np.where(stay, v, moved[:, None]) + scores[begin[:a] + t]
        state = value.argmax(axis=1)
        for t in range(size[0] - 1, -1, -1):
            a = active[t]
            path[begin[:a] + t] = state[:a]
            if t:
                state[:a] = np.where(stays[t, np.arange(a), state[:a]], state[:a], leads[t, :a])
    return path


class _Path:
    """The same for one long text, a stretch of scores after the other; two bytes and a bit a language are kept of a word."""

    def __init__(self, n: int, switch: float) -> None:
        self.switch, self.value = switch, None
        self.leads = array("H")
        self.row = (n + 7) // 8  # bytes that say for which languages it is best to stay
        self.stays = bytearray()

    def extend(self, scores: np.ndarray) -> None:
        value, switch, row = self.value, self.switch, self.row
        for word in scores.astype(np.float64).tolist():
            if value is None:
                value = word
                self.leads.append(0)
                self.stays += bytes(row)
                continue
            top = max(value)
            moved = top - switch
            self.leads.append(value.index(top))
            mask, bit, then = 0, 1, []
            for v, x in zip(value, word, strict=True):
                if v >= moved:
                    mask |= bit
                    then.append(v + x)
                else:
                    then.append(moved + x)
                bit <<= 1
            self.stays += mask.to_bytes(row, "little")
            value = then
        self.value = value

    def path(self) -> np.ndarray:
        out = np.zeros(len(self.leads), dtype=np.int16)
        if self.value is None:
            return out
        state = self.value.index(max(self.value))
        leads, stays, row = self.leads, self.stays, self.row
        for t in range(len(out) - 1, -1, -1):
            out[t] = state
            if not stays[t * row + (state >> 3)] >> (state & 7) & 1:
                state = leads[t]
        return out


_GAP = re.compile(r"[\W\d_]")


def _stretches(text: str | None) -> Iterator[tuple[int, str]]:
    """``text`` cut behind characters that are in no word, about every ``_BATCH`` characters: offsets and parts."""
    at, text = 0, text or ""
    while len(text) - at > _BATCH:
        gap = _GAP.search(text, at + _BATCH)
        # no gap that the pattern knows: cut nowhere
        end = gap.end() if gap else len(text)
        yield at, text[at:end]
        at = end
    if at < len(text):
        yield at, text[at:]


def _words(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and scores of all words of the texts, laid out one after the other, and where each text begins."""
    points, letter, script, begin = _points(texts)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], letter, [False])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    scores = np.zeros((len(starts), len(model.languages)), dtype=np.float32)
    if len(starts):
        where, pair, triple = _grams(points, letter)
        cut = np.searchsorted(where, starts)
        for at in range(0, len(where), _GRAMS):
            part = slice(at, at + _GRAMS)
            gram = model.table[pair[part]] + model.table[triple[part].astype(np.int64) + (1 << BITS)]
            lo, hi = np.searchsorted(cut, [at, at + len(gram)], side="left")
            if lo == len(cut) or cut[lo] > at:  # goes on with the word before
                lo -= 1
            scores[lo:hi] += np.add.reduceat(gram, np.maximum(cut[lo:hi] - at, 0), axis=0)
        allowed = model.writes[script[starts]]
        scores[~allowed & allowed.any(axis=1)[:, None]] -= FOREIGN
        scores[~allowed.any(axis=1)] = 0.0
    return starts, ends, scores, begin


def _runs(path: np.ndarray, owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of words of one text and label: text, start, end, label, letters."""
    new = np.ones(len(path), dtype=bool)
    new[1:] = (path[1:] != path[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(path)) - 1
    return owner[head], starts[head], ends[last], path[head], np.add.reduceat(ends - starts, head)


def _label_long(text: str, model: Model, switch: float) -> list[tuple[int, int, str, int]]:
    path = _Path(len(model.languages), switch)
    starts, ends = [], []
    for at, stretch in _stretches(text):
        s, e, scores, _ = _words([stretch], model)
        path.extend(scores)
        starts.append(s + at)
        ends.append(e + at)
    best = path.path()
    if not len(best):
        return []
    runs = _runs(best, np.zeros(len(best), dtype=np.int8), np.concatenate(starts), np.concatenate(ends))
    return [(s, e, model.languages[k], m) for s, e, k, m in zip(*(x.tolist() for x in runs[1:]), strict=True)]


def label_spans(texts: list[str | None], model: Model, switch: float = SWITCH) -> list[list[tuple[int, int, str, int]]]:
    """Spans of each text: ``(start, end, language, letters)``, in code points, from a first to a last word of one label."""
    out: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
    if not model.languages:
        return out
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or "") < _BATCH):
            size += len(texts[end] or "")
            end += 1
        if size > _BATCH:  # one text
            out[at] = _label_long(texts[at] or "", model, switch)
            at = end
            continue
        starts, ends, scores, begin = _words([t or "" for t in texts[at:end]], model)
        if len(starts):
            first = np.searchsorted(starts, begin)
            lengths = np.diff(first)
            path = _viterbi(scores, first[:-1], np.where(lengths > LONG_TEXT, 0, lengths), switch)
            for d in np.flatnonzero(lengths > LONG_TEXT).tolist():
                one = _Path(len(model.languages), switch)
                one.extend(scores[first[d] : first[d + 1]])
                path[first[d] : first[d + 1]] = one.path()
            doc, s, e, k, m = _runs(path, np.repeat(np.arange(end - at), lengths), starts, ends)
            for d, s, e, k, m in zip(*(x.tolist() for x in (doc, s - begin[doc], e - begin[doc], k, m)), strict=True):
                out[at + d].append((s, e, model.languages[k], m))
        at = end
    return out


SPANS = "array<struct<start: int, end: int, lang: string, letters: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("letters", pa.int32())]))


def label_languages(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``doc_id, spans`` for each row of ``docs``: the language of each stretch of words.

    Null and empty texts and texts without a letter have no spans.  Words of a script that no learned language uses follow
    their neighbours; a text of such words only gets the most frequent learned language.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "end", "lang", "letters")
        for batch in batches:
            spans = label_spans(batch.column("text").to_pylist(), model, switch)
            rows = [[dict(zip(names, s, strict=True)) for s in doc] for doc in spans]
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, _SPAN_TYPE)], names=("doc_id", "spans"))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, spans {SPANS}")


def main_language(spans: Column) -> tuple[Column, Column]:
    """The language with most letters (ties: the first by name) and its share of all letters; ``und`` and 0 without."""
    names = F.array_distinct(F.transform(spans, lambda s: s["lang"]))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["letters"])
    sums = F.transform(
        names,
        lambda n: F.struct(
            (-F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + F.when(s["lang"] == n, s["letters"]).otherwise(0))).alias("less"),
            n.alias("lang"),
        ),
    )
    best = F.array_min(sums)
    return F.coalesce(best["lang"], F.lit("und")), F.coalesce(-best["less"] / F.nullif(total, F.lit(0).cast("long")), F.lit(0.0))
