"""Merge-type subword encoding with seeded merge-dropout, and lossless decoding.

A published SentencePiece BPE model supplies the pieces and their scores; nothing is trained.  Texts are cut where no
piece can reach across, and each cut stretch keeps an agenda of the adjacent pairs whose concatenation is a piece.  The
best candidate (highest score, then leftmost) is taken off the agenda; a keyed hash of seed, document and the candidate's
place decides whether it is skipped, otherwise it is merged and its new neighbours enter the agenda.  So a text has one
segmentation for each seed, whatever machine or partition it is on, and different documents vary.

All stretches of a batch are processed side by side on arrays, one merge a stretch and round; a stretch of many characters
has its own agenda in a heap instead, which takes the same decisions.  A long text is worked on in parts that end where a
stretch does, so memory is bounded by a part (or by a single stretch that is longer) and not by the text.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.shingles import mix64
from leafgraph.llm.store import arrow_batches

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20_240
#: The character that stands for a space inside pieces.
SPACE = "▁"
#: Characters or pieces of one array pass, bytes of the rows that leave together, and characters of the longest stretch
#: that is processed on arrays.
_BATCH = 100_000
_OUT = 1 << 20
LONG = 128
_NEVER = np.int64(1) << np.int64(62)
_PLACE_BITS = 32
_MASK = (1 << 64) - 1
#: What the start, middle and end of a candidate are multiplied with in its hash.
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass
class Pieces:
    of_point: np.ndarray  # piece of a code point of the basic plane, -1: none
    of_far_point: dict[int, int]
    byte_piece: np.ndarray
    text: list[bytes]  # what a piece decodes to
    pairs: dict[int, tuple[int, int]]  # order and merged piece of left << 16 | right
    slots: np.ndarray  # the same as an open-addressed table: key, merged piece, order
    merged: np.ndarray
    order: np.ndarray
    probes: int
    space: int
    pool: np.ndarray
    pool_at: np.ndarray
    pool_len: np.ndarray


_SLOT_BITS = 20


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


@lru_cache(maxsize=4)
def load(model_file: str = DEFAULT_MODEL) -> Pieces:
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=model_file)
    n = processor.get_piece_size()
    normal: dict[str, int] = {}
    byte_piece = np.full(256, -1, dtype=np.int32)
    text: list[bytes] = [b""] * n
    for i in range(n):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            byte_piece[int(piece[3:5], 16)] = i
            text[i] = bytes([int(piece[3:5], 16)])
        elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
            normal[piece] = i
            text[i] = piece.replace(SPACE, " ").encode()
    if (byte_piece < 0).any():
        raise ValueError("the model has no piece for some byte, so not every text could be encoded")
    scores = {i: processor.get_score(i) for i in normal.values()}
    rank = {i: k for k, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i)))}
    pairs: dict[int, tuple[int, int]] = {}
    for piece, i in normal.items():
        for cut in range(1, len(piece)):
            left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left << 16 | right] = (rank[i], i)
    keys = np.array(list(pairs), dtype=np.int64)
    slots = np.full(1 << _SLOT_BITS, -1, dtype=np.int64)
    merged = np.zeros(1 << _SLOT_BITS, dtype=np.int32)
    order = np.zeros(1 << _SLOT_BITS, dtype=np.int64)
    probes = 1
    for key, slot in zip(keys.tolist(), _slot(keys).tolist(), strict=True):
        tried = 1
        while slots[slot] >= 0:
            slot, tried = (slot + 1) & ((1 << _SLOT_BITS) - 1), tried + 1
        slots[slot], order[slot], merged[slot] = key, *pairs[key]
        probes = max(probes, tried)
    of_point = np.full(0x10000, -1, dtype=np.int32)
    far: dict[int, int] = {}
    for piece, i in normal.items():
        if len(piece) == 1 and piece != SPACE:
            if ord(piece) < 0x10000:
                of_point[ord(piece)] = i
            else:
                far[ord(piece)] = i
    lengths = np.array([len(t) for t in text], dtype=np.int64)
    pool = np.frombuffer(b"".join(text), dtype=np.uint8)
    return Pieces(
        of_point, far, byte_piece, text, pairs, slots, merged, order, probes, normal[SPACE], pool, np.cumsum(lengths) - lengths, lengths
    )


def _candidates(p: Pieces, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order (or never) and merged piece of each pair of symbols."""
    order = np.full(len(left), _NEVER, dtype=np.int64)
    into = np.zeros(len(left), dtype=np.int32)
    open_ = np.flatnonzero((left >= 0) & (right >= 0))
    key = left[open_].astype(np.int64) << 16 | right[open_]
    slot = _slot(key)
    for _ in range(p.probes):
        held = p.slots[slot]
        hit = held == key
        order[open_[hit]] = p.order[slot[hit]]
        into[open_[hit]] = p.merged[slot[hit]]
        go = ~hit & (held >= 0)
        if not go.any():
            break
        open_, key, slot = open_[go], key[go], (slot[go] + 1) & ((1 << _SLOT_BITS) - 1)
    return order, into


def _skipped(doc_key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the candidate that joins [start, middle) and [middle, end) of a document is skipped."""
    x = doc_key.copy()
    for place, step in zip((start, middle, end), _STEPS, strict=True):
        x += place.astype(np.uint64) * np.uint64(step)
    return mix64(x) < limit


def _skipped_one(doc_key: int, start: int, middle: int, end: int, limit: int) -> bool:
    """``_skipped`` for one candidate."""
    x = (doc_key + start * _STEPS[0] + middle * _STEPS[1] + end * _STEPS[2]) & _MASK
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & _MASK
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & _MASK
    return (x ^ x >> 33) < limit


def _heap_merge(p: Pieces, symbols: list[int], first: int, doc_key: int, limit: int) -> list[int]:
    """The agenda of one long stretch of one-character symbols that begins at place ``first``.

    A candidate is one number, of order, start and end.  It is out of date when its start has gone or reaches further, or
    when the symbol after that ends elsewhere.
    """
    n = len(symbols)
    symbol = array("i", symbols)
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    end = array("q", range(1, n + 1))
    alive = bytearray(b"\1") * n
    agenda: list[int] = []

    def consider(a: int, b: int) -> None:
        found = p.pairs.get(symbol[a] << 16 | symbol[b]) if symbol[a] >= 0 and symbol[b] >= 0 else None
        if found and not _skipped_one(doc_key, first + a, first + b, first + end[b], limit):
            heapq.heappush(agenda, found[0] << 80 | a << 40 | end[b])

    for i in range(n - 1):
        consider(i, i + 1)
    low = (1 << 40) - 1
    while agenda:
        entry = heapq.heappop(agenda)
        a, to = entry >> 40 & low, entry & low
        b = after[a]
        if not alive[a] or b >= n or end[b] != to:
            continue  # a neighbour has changed since
        symbol[a] = p.pairs[symbol[a] << 16 | symbol[b]][1]
        end[a], alive[b], after[a] = to, 0, after[b]
        if after[a] < n:
            before[after[a]] = a
            consider(a, after[a])
        if before[a] >= 0:
            consider(before[a], a)
    return [s for s, live in zip(symbol, alive, strict=True) if live]


def _array_merge(
    p: Pieces, symbol: np.ndarray, place: np.ndarray, stretch: np.ndarray, doc_key: np.ndarray, limit: np.uint64
) -> tuple[np.ndarray, np.ndarray]:
    """The agendas of all stretches at once: surviving symbols and their places, in order.

    ``stretch`` numbers the stretches in ascending order; ``doc_key`` has a key for each of them.
    """
    out_symbol, out_place = [], []
    n = len(symbol)
    end = place + 1  # of each symbol; a merged one reaches to the end of its last character
    order = np.full(n, _NEVER, dtype=np.int64)
    into = np.zeros(n, dtype=np.int32)

    def refresh(at: np.ndarray) -> None:
        """The candidate that begins at each of these symbols."""
        order[at] = _NEVER
        at = at[at + 1 < len(symbol)]
        at = at[stretch[at] == stretch[at + 1]]
        found, piece = _candidates(p, symbol[at], symbol[at + 1])
        some = np.flatnonzero(found < _NEVER)
        if len(some):
            k = at[some]
            skip = _skipped(doc_key[stretch[k]], place[k], place[k + 1], end[k + 1], limit)
            found[some[skip]] = _NEVER
        order[at], into[at] = found, piece

    refresh(np.arange(n))
    while len(symbol):
        head = np.flatnonzero(np.concatenate(([True], stretch[1:] != stretch[:-1])))
        # the best candidate of each stretch; among equals the leftmost
        best = np.minimum.reduceat(np.where(order < _NEVER, order << _PLACE_BITS | np.arange(len(order)), _NEVER), head)
        going = best < _NEVER
        if not going.all():
            length = np.diff(np.append(head, len(symbol)))
            stays = np.repeat(going, length)
            out_symbol.append(symbol[~stays])
            out_place.append(place[~stays])
            # indices into the arrays that remain
            shift = np.cumsum(~stays)
            at = (best[going] & ((1 << _PLACE_BITS) - 1)).astype(np.int64)
            at -= shift[at]
            symbol, place, end, stretch, order, into = (x[stays] for x in (symbol, place, end, stretch, order, into))
        else:
            at = (best & ((1 << _PLACE_BITS) - 1)).astype(np.int64)
        if not len(symbol):
            break
        symbol[at] = into[at]
        end[at] = end[at + 1]
        keep = np.ones(len(symbol), dtype=bool)
        keep[at + 1] = False
        at -= np.arange(len(at))  # each merge before this one takes one symbol away
        symbol, place, end, stretch, order, into = (x[keep] for x in (symbol, place, end, stretch, order, into))
        left = at[at > 0] - 1
        refresh(np.concatenate([at, left[stretch[left] == stretch[left + 1]]]))
    if not out_symbol:
        return symbol, place
    symbol, place = np.concatenate(out_symbol), np.concatenate(out_place)
    back = np.argsort(place, kind="stable")
    return symbol[back], place[back]


#: No piece has a space after another character: here a stretch ends.
_CUT = re.compile(r"(?<=[^ ]) ")


def _parts(text: str) -> Iterator[tuple[int, str]]:
    """``text`` cut about every ``_BATCH`` characters in front of a space behind another character: offsets and parts."""
    at = 0
    while len(text) - at > 2 * _BATCH:
        cut = _CUT.search(text, at + _BATCH)
        if cut is None:
            break
        yield at, text[at : cut.start()]
        at = cut.start()
    yield at, text[at:]


def encode_batch(
    texts: list[str], keys: np.ndarray, model_file: str = DEFAULT_MODEL, dropout: float = DROPOUT, seed: int = SEED
) -> list[np.ndarray]:
    """Piece ids of each text; ``keys`` (64-bit) name the documents."""
    if not 0.0 <= dropout <= 1.0:
        raise ValueError("dropout lies between 0 and 1")
    p = load(model_file)
    limit = np.uint64(min(int(dropout * 2.0**64), (1 << 64) - 1))
    named = mix64(mix64(np.asarray(keys).astype(np.int64).view(np.uint64) ^ np.uint64(seed)))
    # the model's leading space; nothing for an empty text
    parts = [(i, at, part) for i, t in enumerate(texts) if t for at, part in _parts(" " + t)]
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for a, b in _groups([len(part) for _, _, part in parts]):
        owner = [i for i, _, _ in parts[a:b]]
        pieces = _encode_parts(p, [part for _, _, part in parts[a:b]], np.array([at for _, at, _ in parts[a:b]]), named[owner], limit)
        for i, x in zip(owner, pieces, strict=True):
            found[i].append(x)
    return [x[0] if len(x) == 1 else np.concatenate([np.empty(0, dtype=np.int32), *x]) for x in found]


def _encode_parts(p: Pieces, parts: list[str], offsets: np.ndarray, named: np.ndarray, limit: np.uint64) -> list[np.ndarray]:
    """Piece ids of parts of texts; ``offsets`` say where in its text a part begins, ``named`` are the documents' keys."""
    begin = np.concatenate(([0], np.cumsum([len(t) for t in parts]))).astype(np.int64)
    point = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    symbol = p.of_point[np.where(point > 0xFFFF, 0, point)]
    far = point > 0xFFFF
    if far.any():
        symbol[far] = [p.of_far_point.get(c, -1) for c in point[far].tolist()]
    blank = point == 0x20
    symbol[blank] = p.space
    symbol[point == ord(SPACE)] = -1  # spelled in bytes, so that it is told from a space
    unknown = symbol < 0
    new = np.zeros(len(point), dtype=bool)
    new[begin[:-1]] = True
    new[1:] |= blank[1:] & ~blank[:-1]  # no piece has a space after another character
    new |= unknown
    new[1:] |= unknown[:-1]
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(point)))
    stretch = np.repeat(np.arange(len(head)), length)
    part = np.searchsorted(begin, head, side="right") - 1
    place = np.arange(len(point), dtype=np.int64)
    # candidates are hashed by their places in the batch; taking the place of the text's beginning off the key beforehand
    # makes that the same as hashing places in the text, so a text gets the same pieces in any batch
    doc_key = (named - (begin[:-1] - offsets).astype(np.uint64) * np.uint64(sum(_STEPS) & _MASK))[part]
    long_ = length > LONG
    take = ~np.repeat(long_, length)
    pieces, at = _array_merge(p, symbol[take].copy(), place[take], stretch[take], doc_key, limit)
    extra_symbol, extra_at = [], []
    for k in np.flatnonzero(long_).tolist():
        s, e = int(head[k]), int(head[k] + length[k])
        merged = _heap_merge(p, symbol[s:e].tolist(), s, int(doc_key[k]), int(limit))
        extra_symbol.append(np.array(merged, dtype=np.int32))
        extra_at.append(np.full(len(merged), s, dtype=np.int64))
    if extra_symbol:
        pieces, at = np.concatenate([pieces, *extra_symbol]), np.concatenate([at, *extra_at])
        back = np.argsort(at, kind="stable")
        pieces, at = pieces[back], at[back]
    if unknown.any():
        pieces, at = _spell(p, pieces, at, point)
    return np.split(pieces, np.searchsorted(at, begin[1:-1]))


def _spell(p: Pieces, pieces: np.ndarray, at: np.ndarray, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace symbols without a piece by the pieces of their bytes."""
    missing = np.flatnonzero(pieces < 0)
    spelled = {c: p.byte_piece[list(chr(c).encode("utf-8", "surrogatepass"))] for c in np.unique(point[at[missing]]).tolist()}
    size = np.ones(len(pieces), dtype=np.int64)
    size[missing] = [len(spelled[c]) for c in point[at[missing]].tolist()]
    out, where = np.repeat(pieces, size), np.repeat(at, size)
    if len(missing):
        first = (np.cumsum(size) - size)[missing]
        filled = np.concatenate([spelled[c] for c in point[at[missing]].tolist()])
        spots = np.repeat(first - (np.cumsum(size[missing]) - size[missing]), size[missing]) + np.arange(len(filled))
        out[spots] = filled
    return out, where


def decode_pieces_batch(flat: np.ndarray, offsets: np.ndarray, model_file: str = DEFAULT_MODEL) -> list[str]:
    """The texts of lists of piece ids, given flat with their offsets."""
    p = load(model_file)
    flat = np.asarray(flat)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(p.pool_len)):
        raise ValueError("a piece id lies outside the model")
    ends = np.concatenate(([0], np.cumsum(p.pool_len[flat])))[offsets]
    raw = b"".join(_spelled(p, flat[i : i + _BATCH]) for i in range(0, len(flat), _BATCH))
    # the first character is the leading space that encoding added
    return [raw[a + 1 : b].decode("utf-8", "surrogatepass") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _spelled(p: Pieces, flat: np.ndarray) -> bytes:
    length = p.pool_len[flat]
    done = np.cumsum(length)
    return p.pool[np.repeat(p.pool_at[flat] - (done - length), length) + np.arange(int(done[-1]))].tobytes()


def _groups(sizes: list[int], limit: int | None = None) -> Iterator[tuple[int, int]]:
    first, total, limit = 0, 0, limit or _BATCH
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut into rows of about ``_OUT`` bytes of text, or as many pieces a quarter of that."""
    for batch in batches:
        sizes = batch.column(column)
        sizes = pc.binary_length(sizes) if pa.types.is_string(sizes.type) or pa.types.is_large_string(sizes.type) else pc.list_value_length(sizes)
        limit = _OUT if column == "text" else _OUT // 4
        if not batch.num_rows:
            yield batch
        for a, b in _groups([max(1, n or 0) for n in sizes.to_pylist()], limit):
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, model_file: str = DEFAULT_MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``doc_id, text, pieces`` for each row of ``docs``: a segmentation with ``dropout`` of the merges skipped.

    Null and empty texts have no pieces.  The segmentation depends on text, id and ``seed`` only: repeated rows get the
    same, rows with a null id count as id 0.  ``dropout`` 0 gives the model's own segmentation.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "text"):
            lists, _ = _encoded(batch, model_file, dropout, seed)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text"), lists], names=("doc_id", "text", "pieces"))

    read = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return read.mapInArrow(run, "doc_id long, text string, pieces array<int>")


def _encoded(batch: pa.RecordBatch, model_file: str, dropout: float, seed: int) -> tuple[pa.ListArray, list[str]]:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    keys = np.array([k or 0 for k in batch.column("doc_id").to_pylist()], dtype=np.int64)
    found = encode_batch(texts, keys, model_file, dropout, seed)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
    flat = np.concatenate(found) if found else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())), texts


def round_trip(docs: DataFrame, model_file: str = DEFAULT_MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``doc_id, pieces, lossless`` for each row of ``docs``: ``encode``, and whether ``decode`` of that gives the text again.

    Both run in one Python worker, so that a text goes there once and does not come back.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "text"):
            lists, texts = _encoded(batch, model_file, dropout, seed)
            spelled = decode_pieces_batch(lists.values.to_numpy(), lists.offsets.to_numpy(), model_file)
            same = pa.array([a == b for a, b in zip(texts, spelled, strict=True)], pa.bool_())
            yield pa.record_batch([batch.column("doc_id"), lists, same], names=("doc_id", "pieces", "lossless"))

    read = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return read.mapInArrow(run, "doc_id long, pieces array<int>, lossless boolean")


def decode(encoded: DataFrame, model_file: str = DEFAULT_MODEL, into: str = "decoded") -> DataFrame:
    """``encoded`` with column ``into``, the text that ``pieces`` spell; null or no pieces spell the empty text.

    A column that has that name already is replaced; all others stay.
    """
    arrow_batches(encoded.sparkSession)
    others = [name for name in encoded.columns if name.lower() != into.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "pieces"):
            lists = batch.column("pieces")
            sizes = [n or 0 for n in pc.list_value_length(lists).to_pylist()]
            texts = decode_pieces_batch(lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), model_file)
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=(*others, into))

    kept = encoded.select(*[F.col(f"`{name}`") for name in others])
    shape = ", ".join(f"`{name}` {kind}" for name, kind in kept.dtypes)
    return kept.mapInArrow(run, f"{shape}, `{into}` string")
