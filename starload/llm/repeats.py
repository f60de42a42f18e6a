"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts anywhere else in the corpus.

1. Anchors. In every stretch of ``LENGTH`` bytes the block of ``BLOCK`` bytes with the least hash is an anchor, so equal
   stretches hold the same anchor at the same place. Only anchors whose block occurs twice can lie in a repeat.
2. Contexts. The stretches whose anchor is the same make up its context. A context that occurs twice is covered as
   a whole. Where an anchor has several contexts, one copy of each goes to the shard of its block.
3. Shards. Each builds a suffix array of its contexts by Larsson-Sadakane refinement and their common prefixes by
   Kasai's relation; neighbours that share ``LENGTH`` bytes are repeats. A block with very many contexts is cut over
   several shards. What these leave open is merged by digests, which each shuffle sorts into ranges: first of what
   ``STEP`` neighbouring stretches, counted from the anchor, have in common, and where that meets, of the stretches.
4. The covered spans go back to the texts by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starload.llm.bloom import bitmap, known, may_hold
from starload.llm.common import prepared, stored, text_bytes
from starload.llm.wordhash import NOT_SPACE, grouped, mixed, word_hashes

LENGTH, BLOCK = 400, 128
#: A shard's suffix array spans about so many bytes; a block with more contexts than PIECE is cut.
SHARD_BYTES, PIECE = 1 << 18, 1024
STEP = 8

_RNG = np.random.default_rng(20240711)
BYTES = _RNG.integers(1, 1 << 63, 256, np.uint64)
STEPS = _RNG.integers(1, 1 << 63, 16, np.uint64) | np.uint64(1)
#: The sliding minimum compares so many bits of the hash and, in the others, the place.
PLACE_BITS = np.uint64(27)


def block_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the BLOCK bytes from each place on, by doubling."""
    h, size = BYTES[data], 1
    for step in STEPS[: BLOCK.bit_length() - 1]:
        h = h[:-size] * step + h[size:]
        size *= 2
    return mixed(h)


def anchors(data: np.ndarray, cuts: np.ndarray, most: int = 1 << 26) -> tuple[np.ndarray, ...]:
    """Of the texts between ``cuts``: each anchor's place, block hash, text, and the first and last stretch it stands for.

    More than ``most`` bytes are taken in pieces that share LENGTH - 1 bytes, so that each stretch lies in one of them and a place
    always fits its bits; an anchor whose stretches lie in two pieces comes twice.
    """
    if len(data) > most:
        found = []
        for a in range(0, len(data) - LENGTH + 1, most):
            b = min(len(data), a + most + LENGTH - 1)
            inside = cuts[(cuts > a) & (cuts < b)] - a
            places, hashes, texts, first, last = anchors(data[a:b], np.concatenate(([0], inside, [b - a])), 2 * most + LENGTH)
            found.append((places + a, hashes, texts + np.searchsorted(cuts, a, "right") - 1, first + a, last + a))
        return tuple(np.concatenate(column) for column in zip(*found))
    if len(data) < LENGTH:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    hashes = block_hashes(data)
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    # of equal hashes the last place wins
    least = (hashes & ~mask) | (mask - np.arange(len(hashes), dtype=np.uint64))
    window, size = LENGTH - BLOCK + 1, 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(data) - LENGTH + 1], least[window - size :])
    inside = np.zeros(len(data) + 1, np.int64)
    starts, ends = cuts[:-1], cuts[1:] - LENGTH + 1
    long = ends > starts
    inside[starts[long]] += 1
    inside[ends[long]] -= 1
    stretches = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    chosen = (mask - (least[stretches] & mask)).astype(np.int64)
    # the stretches of an anchor follow each other
    fresh = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(fresh[1:], len(chosen)) - 1
    places = chosen[fresh]
    return places, hashes[places], np.searchsorted(cuts, places, "right") - 1, stretches[fresh], stretches[last]


ANCHORS = "th binary, pos long, kh long, ctx long, lead int, tail int"


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of rows (th, text); the context goes from ``lead`` bytes before the anchor to ``tail`` bytes after its place."""
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        for a, _, data, cuts in grouped(batch.column(1)):
            places, hashes, texts, first, last = anchors(data, cuts)
            if not len(places):
                continue
            raw = data.tobytes()
            lead, ends = places - first, last + LENGTH
            context = np.fromiter((digest(raw[x:y], z) for x, y, z in zip(first.tolist(), ends.tolist(), lead.tolist())), np.uint64, len(places))
            columns = [batch.column(0).take(pa.array(a + texts)), pa.array(places - cuts[texts])]
            columns += [pa.array(hashes.view(np.int64)), pa.array(context.view(np.int64))]
            columns += [pa.array(lead.astype(np.int32)), pa.array((ends - places).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in ANCHORS.split(", ")])


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kh, ctx, n, piece, th, start, left, bytes) of rows (th, text, wanted)."""
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        for th, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            for w in wanted:
                lo = w["pos"] - w["lead"]
                row = (w["kh"], w["ctx"], w["n"], w["piece"], th, lo, w["lead"], text[lo : w["pos"] + w["tail"]])
                for column, value in zip(out, row):
                    column.append(value)
            if len(out[0]) > 2000:
                yield _context_batch(out)
                out = [[] for _ in range(8)]
        yield _context_batch(out)


CONTEXTS = "kh long, ctx long, n long, piece int, th binary, start long, left long, bytes binary"


def _context_batch(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in CONTEXTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


SYMBOLS = 7  # bytes, of nine bits each, in a 64-bit key


def _keys(text: np.ndarray) -> np.ndarray:
    """The first seven bytes of each suffix as a number; beyond the end counts as less than any byte."""
    padded = np.zeros(len(text) + SYMBOLS, np.uint64)
    padded[: len(text)] = text.astype(np.uint64) + np.uint64(1)
    key = np.zeros(len(text), np.uint64)
    for k in range(SYMBOLS):
        key = (key << np.uint64(9)) | padded[k : k + len(text)]
    return key


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order.

    Each round sorts only groups not yet apart, by the ranks of what follows: of the next two parts as long as the
    one sorted so far, or of one if the text is too long for three ranks in a number.
    """
    size = len(text)
    key = _keys(text)
    order = np.argsort(key)
    fresh = np.ones(size, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    slots = np.arange(size)
    rank = np.zeros(size + 1, np.int64)  # the last stands for what is beyond the end
    rank[order] = slots[fresh][np.cumsum(fresh) - 1] + 1
    depth, ahead = SYMBOLS, 2 if size < 1 << 20 else 1
    bits = np.int64(size + 1).item().bit_length()
    while True:
        # a slot is settled if it begins a group and the next slot does too
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        open_slots = np.flatnonzero(~alone)
        if not len(open_slots):
            return order
        starts = order[open_slots]
        both = rank[starts]
        for k in range(1, ahead + 1):
            both = (both << bits) | rank[np.minimum(starts + k * depth, size)]
        by = np.argsort(both)
        starts, both = starts[by], both[by]
        order[open_slots] = starts
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        fresh[open_slots] = new
        rank[starts] = open_slots[new][np.cumsum(new) - 1] + 1
        depth *= ahead + 1


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix, in order, with the one before it, by Kasai's relation.

    In text order a value is one less than that before it, if the suffix and its neighbour are preceded by the
    same byte; only the other suffixes are compared.
    """
    size = len(text)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    places = np.arange(size)
    same = (places > 0) & (before > 0)
    same[same] = text[places[same] - 1] == text[before[same] - 1]
    fresh = places[~same]
    other, key = before[fresh], _keys(text)
    value = np.zeros(len(fresh), np.int64)
    going = np.flatnonzero(other >= 0)
    while len(going):
        x, y = fresh[going] + value[going], other[going] + value[going]
        inside = (x < size) & (y < size)
        going, x, y = going[inside], x[inside], y[inside]
        differ = key[x] ^ key[y]
        equal = differ == 0
        # the highest different bit says how many leading bytes agree
        agree = np.full(len(going), SYMBOLS, np.int64)
        for k in range(SYMBOLS - 1, -1, -1):
            agree[(differ >> np.uint64(9 * (SYMBOLS - 1 - k))) != 0] = k
        # scanning from the last byte to the first leaves the first that differs
        left = size - np.maximum(x, y)
        value[going] += np.minimum(agree, left)
        going = going[equal & (left > SYMBOLS)]
    last = np.maximum.accumulate(np.where(same, 0, places))
    whole = np.zeros(size, np.int64)
    whole[fresh] = value
    by_place = np.maximum(whole[last] - (places - last), 0)
    return by_place[order]


def repeated_starts(parts: list[bytes], owner: np.ndarray, start: np.ndarray, often: np.ndarray):
    """Which stretches of LENGTH bytes of the parts are repeats.

    Returns part numbers and offsets of all such stretches, whether each is a repeat, and whether it is the first of its kind.
    ``owner`` and ``start`` say where a part lies, so that a stretch that two parts share is not its own repeat;
    ``often`` says that the whole part occurs elsewhere too.
    """
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    begin = np.concatenate(([0], np.cumsum(sizes)))
    order = suffix_array(text)
    group = np.cumsum(common_prefixes(text, order) < LENGTH)
    part = np.searchsorted(begin, order, "right") - 1
    offset = order - begin[part]
    valid = offset + LENGTH <= sizes[part]
    part, offset, group = part[valid], offset[valid], group[valid]
    if not len(part):
        return part, offset, np.empty(0, bool), np.empty(0, bool)
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    heads = np.flatnonzero(first)
    place = owner[part] * (1 << 40) + start[part] + offset
    several = np.minimum.reduceat(place, heads) != np.maximum.reduceat(place, heads)
    several |= np.logical_or.reduceat(often[part], heads)
    return part, offset, np.repeat(several, np.diff(np.append(heads, len(group)))), first


COVERED = "kh long, ctx long, lo long, hi long, digest binary, place long, often boolean"


def _covered_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.bool_()]
    names = [x.split()[0] for x in COVERED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _loose(row: dict, text: bytes, lo: int, hi: int, often: bool) -> tuple:
    """A row for the bytes that the stretches from offset ``lo`` to ``hi`` have in common, of which a context may hold only some."""
    digest = hashlib.md5(text[hi : lo + LENGTH], usedforsecurity=False).digest()
    place = xxhash.xxh64_intdigest(row["th"], int(row["start"]) + hi) - (1 << 63)
    first, last = max(lo, 0), min(hi, len(text) - LENGTH)
    return row["kh"], row["ctx"], first - row["left"], last - row["left"] + LENGTH, digest, place, often


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """Covered spans (kh, ctx, lo, hi) relative to the anchor of contexts sorted by (kh, piece).

    Contexts of blocks cut over several shards also give rows with a digest: for STEP neighbouring stretches what
    they have in common, where one of them is the first of its kind or not yet found repeated. Steps are counted from
    the anchor, so equal stretches are in the same step of their contexts, wherever these begin and end.
    """

    def settled(rows: list[dict]) -> pa.RecordBatch:
        owners = {t: k for k, t in enumerate(dict.fromkeys(r["th"] for r in rows))}
        owner, start, left = (np.array([f(r) for r in rows]) for f in (lambda r: owners[r["th"]], lambda r: r["start"], lambda r: r["left"]))
        often, shared = np.array([r["n"] > 1 for r in rows]), np.array([r["piece"] >= 0 for r in rows])
        part, offset, repeat, first = repeated_starts([r["bytes"] for r in rows], owner, start, often)
        out: list[tuple] = []
        by = np.lexsort((offset[repeat], part[repeat]))
        p, o = part[repeat][by], offset[repeat][by]
        if len(p):
            cut = np.flatnonzero((np.diff(p) != 0) | (np.diff(o) > LENGTH)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(p)]):
                k = int(p[a])
                if not often[k]:
                    row = rows[k]
                    out.append((row["kh"], row["ctx"], int(o[a] - left[k]), int(o[b - 1] + LENGTH - left[k]), None, None, None))
        open_ = shared[part] & (first | ~repeat)
        steps = np.unique(np.stack((part[open_], (offset - left[part])[open_] // STEP)), axis=1) if open_.any() else np.empty((2, 0), int)
        for k, step in zip(*steps.tolist()):
            lo = int(left[k]) + step * STEP
            out.append(_loose(rows[k], rows[k]["bytes"], lo, lo + STEP - 1, bool(often[k])))
        return _covered_batch(out)

    held: list[dict] = []
    size, last = 0, None
    for batch in batches:
        for row in batch.to_pylist():
            own = row["kh"], row["piece"]
            if own != last and size >= shard_bytes:
                yield settled(held)
                held, size = [], 0
            last = own
            held.append(row)
            size += len(row["bytes"])
    if held:
        yield settled(held)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the digest of each stretch from ``lo`` to ``hi`` (relative to the anchor) of a context."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            first, last = row["lo"] + row["left"], row["hi"] + row["left"] - LENGTH
            out += [_loose(row, row["bytes"], at, at, row["n"] > 1) for at in range(first, last + 1)]
        yield _covered_batch(out)


def _met(loose: DataFrame) -> DataFrame:
    """The rows whose digest occurs at two places."""
    shared = loose.groupBy("digest").agg(F.min("place").alias("a"), F.max("place").alias("b"), F.max("often").alias("o"))
    return loose.join(shared.filter("a <> b OR o").select("digest"), "digest")


def covered_spans(docs: DataFrame, piece: int = PIECE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(th, spans): for each text with repeats, by its MD5, the covered spans (lo, hi), which may overlap."""
    texts = docs.select(_digest().alias("th"), text_bytes().alias("text"))
    found = stored(texts.filter(F.octet_length("text") >= LENGTH).mapInArrow(_find_anchors, ANCHORS), "anchors")
    twice = found.groupBy("kh").count().filter("count > 1")
    found = stored(found.filter(may_hold(bitmap(twice, "kh"), "kh")), "anchors")
    contexts = found.groupBy("kh", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("th", "pos", "lead", "tail")).alias("at"))
    contexts = stored(contexts.select("kh", "ctx", "n", "at.*"), "contexts")
    # written, so that the join with it can be split where a block has very many contexts
    many = stored(contexts.groupBy("kh").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "many")
    cut = F.ceil(F.col("kinds") / piece)
    number = F.when(cut > 1, F.pmod(F.xxhash64("ctx"), cut)).otherwise(-1).cast("int").alias("piece")
    wanted = contexts.join(many, "kh").select("th", F.struct("pos", "lead", "tail", "kh", "ctx", "n", number).alias("w"))
    wanted = stored(wanted.groupBy("th").agg(F.collect_list("w").alias("wanted")), "wanted")  # as many as a text has anchors
    holders = texts.filter(may_hold(bitmap(wanted.select(F.xxhash64("th").alias("h"))), F.xxhash64("th")))
    holders = holders.groupBy("th").agg(F.any_value("text").alias("text"))
    cut_out = stored(holders.join(wanted, "th").select("th", "text", "wanted").mapInArrow(_cut_contexts, CONTEXTS), "cut")
    sorted_ = cut_out.repartition("kh", "piece").sortWithinPartitions("kh", "piece")
    spans = stored(sorted_.mapInArrow(lambda batches: _shards(batches, shard_bytes), COVERED), "spans")
    within = spans.filter("digest IS NULL").select("kh", "ctx", "lo", "hi")
    # what several shards of a block hold in common, and then the stretches there
    near = _met(spans.filter("digest IS NOT NULL")).select("kh", "ctx", "lo", "hi")
    loose = cut_out.filter("piece >= 0").join(near, ["kh", "ctx"]).mapInArrow(_stretches, COVERED)
    across = _met(stored(loose, "stretches")).select("kh", "ctx", "lo", "hi")
    whole = contexts.filter("n > 1").select("kh", "ctx", (-F.col("lead")).cast("long").alias("lo"), F.col("tail").cast("long").alias("hi"))
    known = within.union(across).union(whole).groupBy("kh", "ctx").agg(F.collect_list(F.struct("lo", "hi")).alias("s"))
    # written, so that the join below can be split where many texts share a context
    known = stored(known, "known")
    there = found.select("th", "pos", "kh", "ctx").distinct().join(known, ["kh", "ctx"])
    placed = F.transform("s", lambda s: F.struct((F.col("pos") + s["lo"]).alias("lo"), (F.col("pos") + s["hi"]).alias("hi")))
    return there.groupBy("th").agg(F.flatten(F.collect_list(placed)).alias("spans"))


#: A passage has PASSAGE words or more; of the runs of HALF words in each PASSAGE words one is the anchor.
PASSAGE, HALF = 51, 26


_FACTOR = 0x9E3779B97F4A7C15


def _runs(words: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Hash of each run of so many words, for every length, put together from runs of powers of two."""
    powers, doubled = [words], 1
    while doubled * 2 <= max(lengths):
        last = powers[-1]
        powers.append(last[: max(0, len(last) - doubled)] * np.uint64(pow(_FACTOR, doubled, 1 << 64)) + last[doubled:])
        doubled *= 2
    out = []
    for length in lengths:
        size, left = max(0, len(words) - length + 1), length
        h, at = np.zeros(size, np.uint64), 0
        for k in reversed(range(length.bit_length())):
            if length >> k & 1:
                left -= 1 << k
                h += powers[k][at : at + size] * np.uint64(pow(_FACTOR, left, 1 << 64))
                at += 1 << k
        out.append(mixed(h))
    return out


def _least(hashes: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` neighbours."""
    least, size = hashes, 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[: len(hashes) - window + 1], least[window - size :])


def passage_hashes(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and anchor of all runs of PASSAGE words within a text; the anchor is the least hash of their runs of HALF words."""
    if len(words) < PASSAGE:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    half, whole = _runs(words, HALF, PASSAGE)
    starts = np.flatnonzero(texts[: len(whole)] == texts[PASSAGE - 1 :])
    return starts, whole[starts], _least(half, PASSAGE - HALF + 1)[starts]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, t) of the anchors of rows (t, text), once for neighbouring passages."""
    for batch in batches:
        own = batch.column(0).to_numpy()
        for a, _, data, cuts in grouped(batch.column(1)):
            words, texts = word_hashes(data, cuts, NOT_SPACE)
            starts, _, anchor = passage_hashes(words, texts)
            if len(starts):
                text = texts[starts]
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), pa.array(own[a + text[new]])], names=["h", "t"])


def _passage_rows(bits: np.ndarray):
    """(h, t, start) of the runs of PASSAGE words, in words from the text's first, whose anchor may be in another text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for a, _, data, cuts in grouped(batch.column(1)):
                words, texts = word_hashes(data, cuts, NOT_SPACE)
                starts, whole, anchor = passage_hashes(words, texts)
                if not len(starts):
                    continue
                may = known(anchor, bits)
                starts, whole = starts[may], whole[may]
                begin = np.searchsorted(texts, texts[starts])
                columns = [pa.array(whole.view(np.int64)), pa.array(own[a + texts[starts]]), pa.array((starts - begin).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "t", "start"])

    return found


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(t, n_passages, n_passage_words) of each text, by a hash of its MD5, with a passage of over 50 words that another text holds too.

    n_passages counts the maximal runs of words that such passages cover, n_passage_words their words. Words are what
    white space parts, A-Z as a-z. Rows that repeat a text are that text; the same passage twice in one text is none. Every 51
    words have the same anchor wherever they stand, so only passages whose anchor is in several texts are compared.
    """
    texts = docs.select(F.xxhash64(_digest()).alias("t"), text_bytes().alias("text")).filter(F.octet_length("text") >= 2 * PASSAGE - 1)

    def shared(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b"))
        return ends.filter("a <> b").select("h")

    bits = bitmap(shared(texts.select("t", "text").mapInArrow(_anchor_rows, "h long, t long")))
    rows = stored(texts.select("t", "text").mapInArrow(_passage_rows(bits), "h long, t long, start int"), "passages")
    # written, so that the join can be split where very many texts hold a passage
    places = rows.join(stored(shared(rows), "shared-passages"), "h").select("t", "start").distinct()
    gap = F.col("start") - F.lag("start").over(W.partitionBy("t").orderBy("start"))
    gap = F.coalesce(gap, F.lit(PASSAGE + 1))
    return places.withColumn("gap", gap).groupBy("t").agg(F.count_if(F.col("gap") > PASSAGE).alias("n_passages"), F.sum(F.least("gap", F.lit(PASSAGE)).cast("long")).alias("n_passage_words"))


def _digest():
    return F.unhex(F.md5(text_bytes()))


KEPT = "t long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, spans, t) without the bytes their spans cover."""
    for batch in batches:
        sizes, kept, counts = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            out, at, runs = [], 0, 0
            for lo, hi in _merged(spans or [], len(text)):
                out.append(text[at:lo])
                at, runs = hi, runs + 1
            kept.append(b"".join([*out, text[at:]]))
            sizes.append(len(text))
            counts.append(runs)
        left = np.array([len(k) for k in kept], np.int64)
        columns = [batch.column(3), batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(sizes, np.int64) - left), pa.array(counts, pa.int64())]
        columns += [pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in KEPT.split(", ")])


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal covered runs within the text."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((max(0, s["lo"]), min(size, s["hi"])) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        elif hi > lo:
            out.append((lo, hi))
    return out


def _spanned(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows (doc_id, text, spans) of ``docs`` with the spans to remove; ``spans`` has th and spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), _digest().alias("th"))
    rows = rows.withColumn("maybe", may_hold(bitmap(spans.select(F.xxhash64("th").alias("h"))), F.xxhash64("th")))
    # texts surely without spans need no shuffle
    clean = rows.filter("NOT maybe").select("doc_id", "text", "th", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return clean.union(rows.filter("maybe").drop("maybe").join(spans, "th", "left").select("doc_id", "text", "th", "spans"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, a null one has none. Every byte goes that is covered by a string of 400 bytes which also
    starts elsewhere, be it in the same text or in another row; rows that repeat a text are repeats of
    each other. n_spans counts the maximal removed runs; kept is what is left, and may be cut within a character. Extra columns are
    not read; an empty table gives no row.
    """
    prepared(docs.sparkSession)
    rows = _spanned(docs, stored(covered_spans(docs), "covered"))
    return rows.select("doc_id", "text", "spans", F.lit(0).cast("long").alias("t")).mapInArrow(_removed, KEPT).drop("t")


def with_passages(docs: DataFrame) -> DataFrame:
    """``without_repeats`` and, for each row, n_passages and n_passage_words as in ``repeated_passages``, zero where there is none.

    A passage of over 50 words may have fewer than 400 bytes: it is then named here and not removed.
    """
    prepared(docs.sparkSession)
    rows = _spanned(docs, stored(covered_spans(docs), "covered"))
    left = rows.select("doc_id", "text", "spans", F.xxhash64("th").alias("t")).mapInArrow(_removed, KEPT)
    # written, so that the join can be split where very many rows repeat a text
    passages = stored(repeated_passages(docs), "passage-counts")
    counted = left.join(passages, "t", "left")
    zero = F.lit(0).cast("long")
    return counted.select(*left.drop("t").columns, *[F.coalesce(c, zero).alias(c) for c in ("n_passages", "n_passage_words")])
