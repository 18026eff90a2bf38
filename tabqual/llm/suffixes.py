"""Removal of long byte strings that occur in an earlier document, by suffix arrays built with a difference cover.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document of a smaller id.

Distribution. Every window of ``length`` bytes is owned by its smallest 24-byte gram (by hash, leftmost), so equal windows are owned by
equal grams. One pass finds the grams that own windows in two documents or more; a second cuts
out the contexts of these grams (all windows that an occurrence owns, some 63 bytes for 14 windows) and deals them out by gram.
So all places that could hold the same window meet in one task, while text that nothing shares is never moved. Texts that
an earlier document has as a whole are settled by their digests beforehand. Grams in very many places are counted
window by window instead, so that no task needs to hold them.

Order. Each task sorts all suffixes of its contexts with the difference-cover algorithm: the suffixes at
positions 1 and 2 modulo 3 are sorted by their triples, named, and sorted by recursion on the names; the
remaining suffixes follow from these and are merged in. Windows with equal prefixes are then neighbours: neighbours are compared,
and every run of equal ones gives the smallest document that holds that window.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.llm import tokens
from tabqual.llm.shared import map_pandas, save, ship_package

LENGTH = 50
GRAM = 24
#: Texts above this are cut into pieces that overlap by a window; numpy works on one piece in the processor's cache.
PIECE_BYTES = 1 << 16
#: Bits of the map of shared grams (16 MB), and how many grams one map takes; more grams take more passes.
MAP_BITS, GRAMS_PER_MAP = 27, 1 << 24
#: Places from which a gram is counted window by window, and bits of the map of such grams.
HOT_PLACES, HOT_MAP_BITS = 6_000, 24
#: Bytes of contexts that are sorted together (a gram that is not hot has no more), and that are packed together.
BLOCK_BYTES, PACKED_BYTES = 400_000, 1 << 22
#: Grams that a task aggregates at once, and expected content of the buckets by which grams and contexts are dealt out.
GRAMS_HELD = 1 << 19
GRAMS_PER_BUCKET, CONTEXTS_PER_BUCKET = 200_000, 60_000
#: Whole copies are told to the tasks as a table up to this many rows; beyond, they are joined.
SHARED_COPIES = 1 << 20
_POSITION = np.uint64((1 << 21) - 1)
LAST = (1 << 63) - 1


# ---------------------------------------------------------------- suffix arrays

def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``s`` in order. Symbols are 1 to 2^21 - 1; the end of ``s`` sorts before all."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    t = np.concatenate((s.astype(np.int64), np.zeros(3, np.int64)))
    sampled = np.arange(n + (n % 3 == 1))
    sampled = np.concatenate((sampled[1::3], sampled[2::3]))  # 1 modulo 3, then 2 modulo 3
    key = (t[sampled] << 42) | (t[sampled + 1] << 21) | t[sampled + 2]
    order = np.argsort(key)
    key = key[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    names = np.empty(len(sampled), np.int64)
    names[order] = np.cumsum(fresh)
    distinct = fresh.all()
    del key, fresh
    if not distinct:
        del order
        order = suffix_array(names)
    del names
    place = np.zeros(n + 3, np.int64)
    by_rank = sampled[order]
    place[by_rank] = np.arange(1, len(by_rank) + 1)
    by_rank = by_rank[by_rank < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort((t[rest] << 21) | place[rest + 1])]
    one, two = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    before = np.searchsorted((t[one] << 21) | place[one + 1], (t[rest] << 21) | place[rest + 1])
    before += np.searchsorted((t[two] << 42) | (t[two + 1] << 21) | place[two + 2],
                              (t[rest] << 42) | (t[rest + 1] << 21) | place[rest + 2])
    out = np.empty(n, np.int64)
    slots = np.arange(len(rest)) + before
    taken = np.zeros(n, bool)
    taken[slots] = True
    out[slots], out[~taken] = rest, by_rank
    return out


def least_holders(contexts: list[bytes], holder: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the contexts ``(context, offset, smallest holder of an equal window)``, in order of place."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    raw = b"\0".join(contexts) + bytes(length)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    n = int(sizes.sum() + len(sizes) - 1)
    symbols = np.frombuffer(raw, np.uint8)[:n].astype(np.int64) + 2
    symbols[starts[1:] - 1] = 1
    counts = np.maximum(sizes - length + 1, 0)
    context = np.repeat(np.arange(len(contexts)), counts)
    offset = np.arange(len(context)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = starts[context] + offset
    window = np.full(n, -1, np.int64)
    window[place] = np.arange(len(place))
    order = window[suffix_array(symbols)]
    order = order[order >= 0]
    eight = np.ndarray((n + length - 7,), "<u8", raw, strides=(1,))
    at = place[order]
    same = np.ones(max(0, len(at) - 1), bool)
    for o in sorted({*range(0, length - 7, 8), length - 8}):
        w = eight[at + o]
        same &= w[1:] == w[:-1]
    first = np.flatnonzero(np.concatenate(([True], ~same)))[:len(at)]
    least = np.minimum.reduceat(holder[context[order]], first) if len(at) else holder[:0]
    out = np.empty(len(at), holder.dtype)
    out[order] = np.repeat(least, np.diff(np.concatenate((first, [len(at)]))))
    return context, offset, out


# ---------------------------------------------------------------- owners of windows

def _pieces(texts, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of ``(row, offset, bytes)`` of bounded size; long texts are cut so that every window lies in one piece."""
    held, size = [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        for at in range(0, max(0, len(b) - length + 1), PIECE_BYTES - length + 1):
            part = b[at:at + PIECE_BYTES]
            if held and size + len(part) > PIECE_BYTES:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield held


def owners(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(part, hash of the owning gram, first window, end of windows)`` of every run of windows with one owner."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    buf = np.frombuffer(b"".join(parts), np.uint8)
    n, span = len(buf) - GRAM + 1, length - GRAM + 1
    up, down = tokens._power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(tokens._BYTE_VALUE[buf] * up[:len(buf)], out=total[1:])
    gram = tokens.mix((total[GRAM:] - total[:-GRAM]) * down[:n])
    least = (gram & ~_POSITION) | np.arange(n, dtype=np.uint64)  # equal hashes: the leftmost
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:-(span - width)], least[span - width:])
    anchor = (least & _POSITION).astype(np.int64)
    part = np.repeat(np.arange(len(parts)), sizes)[:len(anchor)]
    valid = np.arange(len(anchor)) + length <= starts[part + 1]
    first = np.flatnonzero(valid & np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))))
    last = np.flatnonzero(valid & np.concatenate(((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | ~valid[1:], [True])))
    own = part[first]
    # owners have small hashes, so they are mixed once more before anything is dealt out by their leading bits
    return own, tokens.mix(gram[anchor[first]]), first - starts[own], last + 1 - starts[own]


def _planes(values: np.ndarray) -> bytes:
    """The numbers' bytes, all first bytes before all second ones, so that equal high bytes compress."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _aggregated(gram: np.ndarray, holder: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams with their smallest and largest holder and their number of places."""
    order = np.argsort(gram)
    gram, holder = gram[order], holder[order]
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    counts = np.diff(np.concatenate((first, [len(gram)])))
    return gram[first], np.minimum.reduceat(holder, first), np.maximum.reduceat(holder, first), counts


def _bucket_of(gram: np.ndarray, bits: int) -> np.ndarray:
    return (gram >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(gram), np.int64)


def _bits_for(n: float, per_bucket: int) -> int:
    return min(21, max(0, math.ceil(math.log2(max(1.0, n / per_bucket)))))


def shared_grams(rows: DataFrame, length: int, bits: int) -> DataFrame:
    """``(bucket, n, places, grams, hot)``: packed hashes of grams that own windows in two ids or more.

    ``places`` counts where they are; ``hot`` are those with more than ``HOT_PLACES``. Each task's grams are
    aggregated before it is dealt out by the leading bits of the hash, so a gram that is everywhere stays small.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, holders, n = [], [], 0
        for b in batches:
            ids = b["rank"].to_numpy()
            for held in _pieces(b["text"], length):
                own, gram, _, _ = owners([p for _, _, p in held], length)
                grams.append(gram)
                holders.append(ids[np.array([i for i, _, _ in held])][own])
                n += len(gram)
            if n > GRAMS_HELD:
                yield packed(np.concatenate(grams), np.concatenate(holders))
                grams, holders, n = [], [], 0
        if n:
            yield packed(np.concatenate(grams), np.concatenate(holders))

    def packed(gram: np.ndarray, holder: np.ndarray) -> pd.DataFrame:
        gram, *rest = _aggregated(gram, holder)
        bucket = _bucket_of(gram, bits)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        columns = zip(("grams", "least", "most", "counts"), (gram.view(np.int64), *rest))
        return pd.DataFrame({"bucket": bucket[cut[:-1]]} | {
            c: [_planes(v[x:y]) for x, y in zip(cut[:-1], cut[1:])] for c, v in columns})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        gram, least, most, counts = (np.concatenate([_from_planes(v) for v in pdf[c]]) for c in ("grams", "least", "most", "counts"))
        order = np.argsort(gram)
        gram, least, most, counts = gram[order].view(np.uint64), least[order], most[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        keep = np.minimum.reduceat(least, first) < np.maximum.reduceat(most, first)
        found, places = gram[first][keep], np.add.reduceat(counts, first)[keep]
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1].to_numpy(), "n": [len(found)], "places": [int(places.sum())],
                             "grams": [found.tobytes()], "hot": [found[places > HOT_PLACES].tobytes()]})

    dealt = map_pandas(rows.select("rank", "text"), emit,
                       "bucket bigint, grams binary, least binary, most binary, counts binary")
    return dealt.groupBy("bucket").applyInPandas(merge, "bucket bigint, n bigint, places bigint, grams binary, hot binary")


def gram_map(packed: DataFrame, column: str, map_bits: int, bits: int, block: int = 0, blocks: int = 1) -> np.ndarray:
    """Bit map of packed grams (of one block). Every bucket gives its slice, so what reaches the driver has the map's size."""
    width = 1 << (map_bits - bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for bucket, v in zip(b["bucket"], b["grams"]):
                gram = np.frombuffer(v, np.uint64)
                at = np.unique((gram[gram % np.uint64(blocks) == block] >> np.uint64(64 - map_bits)).astype(np.int64) - bucket * width)
                byte, first = np.unique(at >> 3, return_index=True)
                if len(at):
                    own = np.zeros(width >> 3, np.uint8)
                    own[byte] = np.bitwise_or.reduceat(np.uint8(1) << (at & 7).astype(np.uint8), first)
                    yield pd.DataFrame({"bucket": [bucket], "bits": [own.tobytes()]})

    slices = map_pandas(packed.select("bucket", F.col(column).alias("grams")).filter(F.length("grams") > 0), run,
                        "bucket bigint, bits binary")
    out = np.zeros(1 << (map_bits - 3), np.uint8)
    for r in slices.collect():
        out[r["bucket"] * (width >> 3):(r["bucket"] + 1) * (width >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return out


class _Chosen:
    """The grams of a block of shared ones: hot, or not; or both."""

    def __init__(self, shared: np.ndarray, hot: np.ndarray, block: int, blocks: int):
        self.shared, self.hot, self.block, self.blocks = shared, hot, block, blocks

    @staticmethod
    def _in(bits: np.ndarray, map_bits: int, gram: np.ndarray) -> np.ndarray:
        at = gram >> np.uint64(64 - map_bits)
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def mask(self, gram: np.ndarray, hot: bool | None) -> np.ndarray:
        out = self._in(self.shared, MAP_BITS, gram) & (gram % np.uint64(self.blocks) == self.block)
        return out if hot is None else out & (self._in(self.hot, HOT_MAP_BITS, gram) == hot)

    def contexts(self, b: pd.DataFrame, length: int, hot: bool | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
        """``(gram, row, offset, context)`` of every occurrence, for a bounded part of the batch at a time."""
        for held in _pieces(b["text"], length):
            own, gram, first, end = owners([p for _, _, p in held], length)
            hit = self.mask(gram, hot)
            own, gram, first, end = own[hit], gram[hit], first[hit], end[hit]
            row, offset = (np.array([h[k] for h in held], np.int64)[own] for k in (0, 1))
            parts = [p for _, _, p in held]
            texts = [parts[p][x:y] for p, x, y in zip(own.tolist(), first.tolist(), (end + length - 1).tolist())]
            yield gram, row, offset + first, texts


def _context_hash(texts: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)


# ---------------------------------------------------------------- earlier holders of windows

_RUNS = "gram bigint, ctx bigint, lo bigint, hi bigint, holder bigint"


def _runs(gram: np.ndarray, ctx: np.ndarray, texts: list[bytes], least: np.ndarray, most: np.ndarray, length: int) -> pd.DataFrame:
    """Runs of windows ``[lo, hi)`` of distinct contexts whose smallest holder is smaller than some holder of the context."""
    context, offset, holder = least_holders(texts, least, length)
    use = holder < most[context]
    new = np.concatenate(([True], (context[1:] != context[:-1]) | (holder[1:] != holder[:-1]) | ~use[:-1]))
    first = np.flatnonzero(use & new)
    ends = np.flatnonzero(use & np.concatenate((new[1:] | ~use[1:], [True])))
    c = context[first]
    return pd.DataFrame({"gram": gram[c], "ctx": ctx[c], "lo": offset[first], "hi": offset[ends] + 1, "holder": holder[first]})


def _sorted_bucket(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Runs of one bucket of packed contexts; its grams are sorted in blocks of bounded size, a gram always as a whole."""
    unpack = zstandard.ZstdDecompressor()
    gram, least, most = (np.concatenate([_from_planes(v) for v in pdf[c]]) for c in ("grams", "least", "most"))
    texts: list[bytes] = []
    for sizes, packed in zip(pdf["sizes"], pdf["texts"]):
        ends = np.cumsum(np.frombuffer(sizes, np.uint16)).tolist()
        whole = unpack.decompress(packed)
        texts += [whole[x:y] for x, y in zip([0, *ends[:-1]], ends)]
    ctx = _context_hash(texts)
    order = np.lexsort((ctx, gram))
    gram, ctx, least, most = gram[order], ctx[order], least[order], most[order]
    of_ctx = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (ctx[1:] != ctx[:-1]))))
    place = order[of_ctx]
    gram, ctx, least, most = gram[of_ctx], ctx[of_ctx], np.minimum.reduceat(least, of_ctx), np.maximum.reduceat(most, of_ctx)
    of_gram = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    shared = np.minimum.reduceat(least, of_gram) < np.maximum.reduceat(most, of_gram)  # the map also lets others through
    keep = np.repeat(shared, np.diff(np.concatenate((of_gram, [len(gram)]))))
    gram, ctx, least, most, place = gram[keep], ctx[keep], least[keep], most[keep], place[keep]
    texts = [texts[i] for i in place.tolist()]
    size = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    edges = np.concatenate((np.flatnonzero(gram[1:] != gram[:-1]) + 1, [len(gram)])) if len(gram) else np.zeros(0, np.int64)
    del pdf
    out, at = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("gram", "ctx", "lo", "hi", "holder")})], 0
    while at < len(gram):
        fits = np.searchsorted(size[edges], size[at] + BLOCK_BYTES, "right") - 1
        cut = int(edges[max(fits, np.searchsorted(edges, at, "right"))])
        out.append(_runs(gram[at:cut], ctx[at:cut], texts[at:cut], least[at:cut], most[at:cut], length))
        at = cut
    return pd.concat(out)


def _dealt_contexts(rows: DataFrame, chosen, places: int, length: int) -> DataFrame:
    """Packed contexts of grams that are not hot, with their smallest and largest holder in a part of a batch, by bucket."""
    bits = _bits_for(places, CONTEXTS_PER_BUCKET)

    def pack(gram, least, most, texts) -> pd.DataFrame:
        pack_text = zstandard.ZstdCompressor(level=1)
        bucket = _bucket_of(gram, bits)
        order = np.argsort(bucket, kind="stable")
        bucket, gram, least, most = bucket[order], gram[order], least[order], most[order]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        own = [[texts[i] for i in order[x:y].tolist()] for x, y in zip(cut[:-1], cut[1:])]
        columns = zip(("grams", "least", "most"), (gram.view(np.int64), least, most))
        return pd.DataFrame({"bucket": bucket[cut[:-1]]} | {c: [_planes(v[x:y]) for x, y in zip(cut[:-1], cut[1:])] for c, v in columns} | {
            "sizes": [np.array(list(map(len, t)), np.uint16).tobytes() for t in own],
            "texts": [pack_text.compress(b"".join(t)) for t in own]})

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = {}, 0
        for b in batches:
            ids = b["rank"].to_numpy()
            for gram, row, _, texts in chosen.value.contexts(b, length, False):
                for g, t, h in zip(gram.tolist(), texts, ids[row].tolist()):
                    known = held.get((g, t))
                    if known is None:
                        held[g, t] = (h, h)
                        size += len(t)
                    elif h < known[0] or h > known[1]:
                        held[g, t] = (min(h, known[0]), max(h, known[1]))
                if size > PACKED_BYTES:
                    yield packed(held)
                    held, size = {}, 0
        if held:
            yield packed(held)

    def packed(held: dict) -> pd.DataFrame:
        holders = np.array(list(held.values()), np.int64)
        return pack(np.array([g for g, _ in held], np.uint64), holders[:, 0], holders[:, 1], [t for _, t in held])

    return map_pandas(rows.select("rank", "text"), emit,
                      "bucket bigint, grams binary, least binary, most binary, sizes binary, texts binary")


def _hot_runs(rows: DataFrame, chosen, length: int) -> DataFrame:
    """The same runs for the hot grams, counted window by window: no task holds a whole gram."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = b["rank"].to_numpy()
            least: dict[tuple[int, bytes], int] = {}
            for gram, row, _, texts in chosen.value.contexts(b, length, True):
                for g, t, h in zip(gram.view(np.int64).tolist(), texts, ids[row].tolist()):
                    least[g, t] = min(h, least.get((g, t), h))
            found = [(g, xxhash.xxh3_64_intdigest(t), j, *np.frombuffer(hashlib.md5(t[j:j + length]).digest(), np.int64).tolist(), h)
                     for (g, t), h in least.items() for j in range(len(t) - length + 1)]
            pdf = pd.DataFrame(found, columns=["gram", "ctx", "lo", "w1", "w2", "holder"])
            yield pdf.assign(ctx=pdf["ctx"].astype(np.uint64).to_numpy().view(np.int64))

    each = map_pandas(rows.select("rank", "text"), emit, "gram bigint, ctx bigint, lo bigint, w1 bigint, w2 bigint, holder bigint")
    each = save(each.groupBy("gram", "ctx", "lo", "w1", "w2").agg(F.min("holder").alias("holder")), "hot-windows")
    least = save(each.groupBy("w1", "w2").agg(F.min("holder").alias("holder")), "hot-holders")
    return each.drop("holder").join(least, ["w1", "w2"]).select("gram", "ctx", "lo", (F.col("lo") + 1).alias("hi"), "holder")


def _occurrences(rows: DataFrame, chosen, length: int) -> DataFrame:
    """``(gram, ctx, rank, row_key, at)``: where the contexts of shared grams are."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, keys = b["rank"].to_numpy(), b["row_key"].to_numpy()
            parts = [(gram.view(np.int64), _context_hash(texts), ids[row], keys[row], at)
                     for gram, row, at, texts in chosen.value.contexts(b, length, None)]
            if parts:
                yield pd.DataFrame(dict(zip(("gram", "ctx", "rank", "row_key", "at"), map(np.concatenate, zip(*parts)))))

    return map_pandas(rows, emit, "gram bigint, ctx bigint, rank bigint, row_key bigint, at bigint")


def earlier_spans(rows: DataFrame, length: int) -> DataFrame:
    """``(rank, row_key, span)``: byte ranges of ``rows (rank, row_key, text)`` that a row of smaller rank holds."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bits_for(total / (length - GRAM + 2) * 2, GRAMS_PER_BUCKET)
    shared = save(shared_grams(rows, length, bits), "grams")
    sums = shared.agg(F.sum("n").alias("n"), F.sum("places").alias("places"), F.sum(F.length("hot")).alias("hot")).first()
    blocks = max(1, -(-(sums["n"] or 0) // GRAMS_PER_MAP))
    hot = gram_map(shared, "hot", HOT_MAP_BITS, bits)
    out = None
    for block in range(blocks):
        own = gram_map(shared, "grams", MAP_BITS, bits, block, blocks)
        chosen = rows.sparkSession.sparkContext.broadcast(_Chosen(own, hot, block, blocks))
        dealt = _dealt_contexts(rows, chosen, (sums["places"] or 0) // blocks, length)
        runs = dealt.groupBy("bucket").applyInPandas(lambda pdf: _sorted_bucket(pdf, length), _RUNS)
        if sums["hot"]:
            runs = runs.unionByName(_hot_runs(rows, chosen, length))
        runs = save(runs, "runs")
        places = _occurrences(rows, chosen, length).join(runs, ["gram", "ctx"]).filter("holder < rank")
        part = places.select("rank", "row_key", F.struct((F.col("at") + F.col("lo")).alias("a"),
                                                         (F.col("at") + F.col("hi") + (length - 1)).alias("b")).alias("span"))
        out = part if out is None else out.unionByName(part)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with a column ``spans``: the removed byte ranges ``[start, end)`` of each text, as sorted disjoint pairs.

    ``length`` is 24 at least. Ids are numeric; rows with a NULL id come after all others, and rows that share an id do not remove
    from one another. NULL counts as the empty text; texts shorter than ``length`` lose nothing. Equal rows get equal results; an
    empty table stays empty. Other columns stay as they are; ``docs`` has none named ``spans`` or ``row_key``.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} at least")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rank, key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)), F.xxhash64(text)
    rows = docs.select(rank.alias("rank"), key.alias("row_key"), text.alias("text"))
    # a text that an earlier row has as a whole is removed as a whole, and removes nothing that this row does not
    digests = save(rows.select("rank", "row_key", F.octet_length("text").cast("bigint").alias("size"),
                               F.md5("text").alias("digest")).distinct().filter(F.col("size") >= length), "digests")
    first = save(digests.groupBy("digest").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    copies = save(digests.join(first, "digest").filter("rank > first").select("rank", "row_key", "size"), "copies")
    few = copies.count() <= SHARED_COPIES
    known = copies.select("rank", "row_key")
    rows = rows.join(F.broadcast(known) if few else known, ["rank", "row_key"], "left_anti")
    whole = copies.select("rank", "row_key", F.struct(F.lit(0).cast("bigint").alias("a"), F.col("size").alias("b")).alias("span"))
    spans = earlier_spans(rows, length).unionByName(whole)
    per = spans.groupBy("rank", "row_key").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    start = F.array().cast("array<struct<a:bigint,b:bigint>>")
    per = save(per, "spans").withColumnRenamed("rank", "own_rank").withColumnRenamed("row_key", "own_key")
    keyed = docs.withColumn("row_key", key)
    hit = (F.coalesce(keyed[id_col].cast("bigint"), F.lit(LAST)) == per["own_rank"]) & (keyed["row_key"] == per["own_key"])
    return keyed.join(per, hit, "left").select(*[keyed[c] for c in docs.columns], F.coalesce("spans", start).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row; ``kept`` holds the remaining bytes.

    See :func:`repeated_spans` for NULLs, ties and repeated rows.
    """
    rows = repeated_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", length)
    kind = docs.schema[id_col].dataType.simpleString()
    ship_package(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, spans in zip(b.column(1), b.column(2)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                own = merged([(s["a"], s["b"]) for s in spans.as_py()])
                edges = [0, *(x for s in own for x in s), len(data)]
                kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2]))
                for c, v in zip(out, (len(data), len(data) - len(kept), len(own), hashlib.sha256(kept).hexdigest(), kept)):
                    out[c].append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(out.values(), types))],
                                             names=["id", *out])

    return rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
                           ).withColumnRenamed("id", id_col)
