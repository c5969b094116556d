"""Exact removal of substrings that an earlier document also holds, by prefix-free parsing.

The corpus is dealt into buckets in such a way that all equal windows (strings of ``length`` bytes) meet
in one; each bucket is then put into corpus order by prefix-free parsing, and equal windows stand
together in that order.

1. Documents are packed into blocks, written once to the shared folder.  A rolling hash over ``gram``
   bytes gives each window an anchor, its gram of the least hash.  Consecutive windows with one anchor
   form a passage, so each window lies in exactly one, and equal windows have equal anchors.
2. Each block sends the distinct anchors of its passages, packed and compressed, to buckets; a bucket
   answers for each: does another document have it, and is it frequent?  Text of which the corpus holds
   no copy ends here, for a few bytes a passage.  Passages of a frequent anchor are split by a second
   one, so that an anchor with ever new surroundings does not meet in one place.
3. Each block sends its surviving passages, each distinct one once with the smallest id among its
   documents, to the bucket of their anchor.  There
   * a second rolling hash, over ``PHRASE_GRAM`` bytes, marks triggers; a phrase reaches from one trigger
     through the next, so that neighbours overlap by a gram and no phrase is the beginning of another;
   * the distinct phrases are the dictionary; the passages, as ranks of phrases, are the parse;
   * the suffix array of the dictionary orders what follows a window's start in its phrase, the suffix
     array of the parse orders what comes after that phrase, and both together give corpus order;
   * in that order equal windows form runs, and each run has a first document.
4. The answers, a bit a window, go back to the blocks, which cut the text.

Every message is a packed array with at most one entry a passage a block, so a passage that a third of
all documents share meets in a bucket once for each block only.  Texts are read from the shared folder
where they are worked on and do not travel.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.blocks import packed, read_blocks, spread, tasks, with_files
from listweave.llm.common import arrow_limits, text_bytes, written
from listweave.llm.packing import groups, pack_sorted, squeezed, unpack_sorted, unsqueezed

#: Bytes of a repeated substring and of the rolling hash that anchors it.
LENGTH, GRAM = 50, 16
#: Windows that are hashed at a time, so that the arrays stay in the cache.
STEP = 1 << 18
#: What a bucket holds: anchors, and bytes of passages.
BUCKET_HASHES, BUCKET_BYTES = 1_000_000, 4_000_000
#: An anchor with more passages than this is split by a second one.
FREQUENT = 20_000
#: Bytes of the gram that ends a phrase, and grams to a phrase, about.
PHRASE_GRAM, PHRASE_EVERY = 8, 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD6E8FEB86659FD93)
#: Masks that keep the first 0 to 8 bytes of eight.
_FIRST = np.array([(1 << 64) - (1 << (64 - 8 * k)) for k in range(9)], np.uint64)


def rolling_hash(t: np.ndarray, k: int) -> np.ndarray:
    """Mixed polynomial hash modulo 2**64 of each k bytes, by doubling."""
    power, length, h = _BASE, 1, t.astype(np.uint64) + np.uint64(1)
    parts, have, rest = None, 0, k
    while rest:
        if rest & 1:
            # h covers ``length`` bytes; append it after what is there
            parts = h if parts is None else parts[: len(h) - have] * power + h[have:]
            have += length
        rest >>= 1
        if rest:
            h = h[:-length] * power + h[length:]
            with np.errstate(over="ignore"):
                power, length = power * power, 2 * length
    h = parts[: len(t) - k + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return np.minimum(a[: len(a) - (width - size)], a[width - size :]) if size < width else a


def passages(t: np.ndarray, sizes: np.ndarray, length: int = LENGTH, k: int = GRAM, second: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor of 48 bits) of each passage of the concatenated documents.

    Windows that would cross documents are left out, so texts shorter than ``length`` have no passage.
    ``second`` takes the anchors under another hash.
    """
    n = len(t) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    firsts, counts, hashes = [], [], []
    for a in range(0, n, STEP):
        b = min(n, a + STEP)
        h = rolling_hash(t[a : b + length - 1], k)
        if second:
            h = (h ^ (h >> np.uint64(31))) * _SECOND
        numbered = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_min(numbered, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ok = np.flatnonzero(np.arange(a, b) + length <= ends[a:b])
        if not len(ok):
            continue
        g, d = anchor[ok], doc[ok + a]
        new = np.ones(len(ok), bool)
        new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        firsts.append(ok[at] + a)
        counts.append(np.diff(np.append(at, len(ok))))
        hashes.append(h[g[at]] >> np.uint64(16))
    if not firsts:
        return none, none, none.astype(np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(hashes)


class Block:
    """The rows of a block: text bytes, ids (null ids take no part) and passages.

    The last column of ``rows`` is the id, the last but one the text.
    """

    def __init__(self, rows: pa.RecordBatch, length: int, k: int):
        self.rows, self.length, self.k = rows, length, k
        n = rows.num_columns
        texts = text_bytes(rows, rows.schema.names[n - 2])
        ids = rows.column(n - 1)
        self.sizes = np.array([len(x) for x in texts], np.int64)
        self.text = b"".join(texts)
        self.t = np.frombuffer(self.text, np.uint8)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        first, count, h = passages(self.t, self.sizes, length, k)
        doc = np.searchsorted(self.sizes.cumsum(), first, side="right")
        use = (~np.asarray(ids.is_null()))[doc]
        self.first, self.count, self.hash, self.doc = first[use], count[use], h[use], doc[use]

    def anchors(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors by (bucket, anchor), their buckets, whether two ids have them, passages; index of each passage."""
        value, index, times = np.unique(self.hash, return_inverse=True, return_counts=True)
        low = np.full(len(value), np.iinfo(np.int64).max)
        high = np.full(len(value), np.iinfo(np.int64).min)
        own = self.ids[self.doc]
        np.minimum.at(low, index, own)
        np.maximum.at(high, index, own)
        bucket = (value % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((value, bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return value[order], bucket[order], (low != high)[order], times[order], place[index]

    def keep(self, alive: np.ndarray, frequent: np.ndarray) -> None:
        """Go on with the passages that are ``alive``, those of a ``frequent`` anchor split by a second one."""
        plain, split = np.flatnonzero(alive & ~frequent), np.flatnonzero(alive & frequent)
        first, count, h, doc = self.first[plain], self.count[plain], self.hash[plain], self.doc[plain]
        if len(split):
            sizes = self.count[split] + self.length - 1
            begin = sizes.cumsum() - sizes
            text = self.t[np.repeat(self.first[split] - begin, sizes) + np.arange(sizes.sum())]
            own, n, h2 = passages(text, sizes, self.length, self.k, second=True)
            of = np.searchsorted(sizes.cumsum(), own, side="right")
            first = np.concatenate([first, own - begin[of] + self.first[split][of]])
            count = np.concatenate([count, n])
            h = np.concatenate([h, (self.hash[split][of] ^ (h2 * _BASE)) >> np.uint64(8)])
            doc = np.concatenate([doc, self.doc[split][of]])
        self.first, self.count, self.hash, self.doc = first, count, h, doc

    def distinct(self, buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct passages by bucket, their buckets and first ids; index of each passage."""
        index: dict[bytes, int] = {}
        start, stop = self.first.tolist(), (self.first + self.count + self.length - 1).tolist()
        which = np.fromiter((index.setdefault(self.text[a:b], len(index)) for a, b in zip(start, stop, strict=True)), np.int64, len(start))
        bucket, low = np.zeros(len(index), np.int64), np.full(len(index), np.iinfo(np.int64).max)
        bucket[which] = (self.hash // np.uint64(7) % np.uint64(buckets)).astype(np.int64)
        np.minimum.at(low, which, self.ids[self.doc])
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        words = list(index)
        return [words[i] for i in order.tolist()], bucket[order], low[order], place[which]


def _shared(frame: pd.DataFrame, frequent: int) -> pd.DataFrame:
    """For each block's anchors in this bucket: another document has it; it is frequent besides."""
    values = [unpack_sorted(x) for x in frame["hashes"]]
    cuts = np.cumsum([len(v) for v in values])[:-1]
    merged, index, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    many = count > 1
    flags = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(v)) for f, v in zip(frame["flags"], values, strict=True)])
    np.logical_or.at(many, index, flags.astype(bool))
    times = np.concatenate([np.frombuffer(unsqueezed(x), "<u4") for x in frame["times"]])
    often = np.bincount(index, times, len(merged)) > frequent
    alive, often = many[index], (many & often)[index]
    return pd.DataFrame({
        "block": frame.block, "bucket": frame.bucket, "bits": [np.packbits(p).tobytes() for p in np.split(alive, cuts)],
        "often": [np.packbits(p).tobytes() if p.any() else b"" for p in np.split(often, cuts)], "alive": [int(x.sum()) for x in np.split(np.where(alive, times, 0), cuts)],
    })


# -- prefix-free parsing of a bucket -----------------------------------------------------------------


def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number that sorts like them; zeros beyond the end."""
    out = np.zeros(len(t), np.uint64)
    for j in range(min(8, len(t))):
        out[: len(t) - j] |= t[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
    return out


def parse(t: np.ndarray, sizes: np.ndarray, gram: int = PHRASE_GRAM, every: int = PHRASE_EVERY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text) of each phrase of the concatenated texts, none of which is empty.

    A gram whose hash is 0 modulo ``every`` is a trigger, wherever it stands but at a text's beginning.
    It ends one phrase and begins the next; a text's last phrase ends with the text.
    """
    ends = sizes.cumsum()
    begins = ends - sizes
    if len(t) >= gram:
        at = np.flatnonzero(rolling_hash(t, gram) % np.uint64(every) == 0)
        of = np.searchsorted(ends, at, side="right")
        at = at[(at + gram <= ends[of]) & (at > begins[of])]
    else:
        at = np.zeros(0, np.int64)
    begin = np.sort(np.concatenate([begins, at]))
    of = np.searchsorted(ends, begin, side="right")
    last = np.append(of[1:] != of[:-1], True)
    end = np.where(last, ends[of], np.append(begin[1:], 0) + gram)
    return begin, end, of


def _ranked(start: np.ndarray, size: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Ranks of the strings at ``start`` of ``size`` bytes; equal strings have equal ranks.

    Eight bytes at a time, and only among those that are still equal.
    """
    n = len(start)
    order, group = np.arange(n), np.zeros(n, np.int64)
    tied, depth, longest = np.arange(n), 0, int(size.max(initial=0))
    while len(tied) and depth <= longest:
        who = order[tied]
        left = np.clip(size[who] - depth, 0, 8)
        value = words[np.minimum(start[who] + depth, len(words) - 1)] & _FIRST[left]
        by = np.lexsort((left, value, group[tied]))
        order[tied] = who[by]
        value, left = value[by], left[by]
        split = np.zeros(n + 1, np.int64)
        differ = (value[1:] != value[:-1]) | (left[1:] != left[:-1])
        split[tied[1:][differ]] = 1
        new = np.zeros(n, bool)
        new[1:] = (group[1:] != group[:-1]) | (split[1:n] == 1)
        group = new.cumsum()
        same = np.zeros(n, bool)
        same[1:] = ~new[1:]
        same[:-1] |= ~new[1:]
        done = np.zeros(n, bool)
        done[tied] = left < 8  # those that end here and are equal stay so
        tied = np.flatnonzero(same & ~done)
        depth += 8
    out = np.empty(n, np.int64)
    out[order] = group
    return out


def parse_ranks(phrase: np.ndarray, of: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix of the parse (inverse suffix array), by prefix doubling over phrases.

    ``phrase`` has the ranks of the phrases, ``of`` their texts; a suffix ends with its text.  Suffixes
    that agree in ``depth`` phrases may have equal ranks.
    """
    rank, width, n = phrase.astype(np.int64), 1, len(phrase)
    while width < depth:
        follows = np.zeros(n, np.int64)
        if width < n:
            same = of[width:] == of[:-width]
            follows[:-width][same] = rank[width:][same] + 1
        distinct, rank = np.unique(rank * (n + 2) + follows, return_inverse=True)
        width *= 2
        if len(distinct) == n:
            break
    return rank


def runs(words: list[bytes], length: int, gram: int = PHRASE_GRAM, every: int = PHRASE_EVERY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows in corpus order, run of each of them, text of each window) of texts of ``length`` bytes or more.

    Windows are numbered text by text.  Those of one run are equal, those of different runs differ.
    """
    size = np.array([len(w) for w in words], np.int64)
    t = np.frombuffer(b"".join(words), np.uint8)
    eight = _words(t)
    begin, end, of = parse(t, size, gram, every)
    index: dict[bytes, int] = {}
    whole = t.tobytes()
    which = np.fromiter((index.setdefault(whole[a:b], len(index)) for a, b in zip(begin.tolist(), end.tolist(), strict=True)), np.int64, len(begin))
    dictionary = list(index)
    by = sorted(range(len(dictionary)), key=dictionary.__getitem__)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    phrase = rank[which]
    after = parse_ranks(phrase, of, length)
    # windows: where they start, in which phrase, how much of the phrase is left
    windows = size - length + 1
    offset = windows.cumsum() - windows
    text = np.repeat(np.arange(len(words)), windows)
    start = np.arange(int(windows.sum())) - offset[text] + (size.cumsum() - size)[text]
    own = np.searchsorted(begin, start, side="right") - 1
    left = np.minimum(end[own] - start, length)
    # suffix array of the dictionary, at the places where windows start
    longest = int((end - begin).max(initial=1))
    suffix, at, back = np.unique(phrase[own] * (longest + 1) + (start - begin[own]), return_index=True, return_inverse=True)
    alpha = _ranked(start[at], left[at], eight)[back]
    # combined with that of the parse: what follows the phrase, where the window reaches beyond it
    beyond = left < length
    follows = np.zeros(len(start), np.int64)
    follows[beyond] = after[own[beyond] + 1] + 1
    order = np.argsort(alpha * (len(begin) + 2) + follows, kind="stable")
    a, b = start[order[:-1]], start[order[1:]]
    # neighbours in corpus order are equal if the phrase's rest is, and what the windows reach beyond it
    same = alpha[order[:-1]] == alpha[order[1:]]
    check = np.flatnonzero(same & beyond[order[1:]])
    for depth in range(0, length, 8):
        ok = (eight[a[check] + depth] ^ eight[b[check] + depth]) & _FIRST[min(8, length - depth)] == 0
        same[check[~ok]] = False
        check = check[ok]
    return order, np.concatenate([[0], (~same).cumsum()])[: len(order)], text


def _first_documents(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """For each block's passages in this bucket, a bit a window: a smaller id than the block's has it."""
    index: dict[bytes, int] = {}
    which, lows = [], []
    for data in frame["entries"]:
        words, low = _unpack_entries(data)
        which.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)))
        lows.append(low)
    words = list(index)
    low = np.full(len(words), np.iinfo(np.int64).max)
    np.minimum.at(low, np.concatenate(which), np.concatenate(lows))
    order, run, text = runs(words, length)
    least = np.minimum.reduceat(low[text[order]], np.flatnonzero(np.diff(run, prepend=-1)))
    first = np.empty(len(order), np.int64)
    first[order] = least[run]
    windows = np.array([len(w) for w in words], np.int64) - length + 1
    offset = windows.cumsum() - windows
    bits = []
    for w, own in zip(which, lows, strict=True):
        n = windows[w]
        inner = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
        bits.append(np.packbits(first[np.repeat(offset[w], n) + inner] < np.repeat(own, n)).tobytes())
    return pd.DataFrame({"block": frame.block, "bucket": frame.bucket, "bits": bits})


def _pack_entries(words: list[bytes], low: np.ndarray) -> bytes:
    sizes = np.array([len(w) for w in words], "<u4")
    return squeezed(len(words).to_bytes(4, "little") + sizes.tobytes() + low.astype("<i8").tobytes() + b"".join(words))


def _unpack_entries(data: bytes) -> tuple[list[bytes], np.ndarray]:
    raw = unsqueezed(data)
    n = int.from_bytes(raw[:4], "little")
    ends = np.frombuffer(raw, "<u4", n, 4).cumsum() + 4 + 12 * n
    stops = ends.tolist()
    return [raw[a:b] for a, b in zip([4 + 12 * n, *stops[:-1]], stops, strict=True)], np.frombuffer(raw, "<i8", n, 4 + 4 * n)


def _by_bucket(answers: list[dict] | None, width: dict[int, int], field: str = "bits") -> np.ndarray:
    """The answers' bits in the order of buckets; ``width``: bits of each bucket.  Empty bits are zeros."""
    got = {a["bucket"]: a[field] for a in answers or []}
    parts = [np.unpackbits(np.frombuffer(got[b], np.uint8), count=n) if got[b] else np.zeros(n, np.uint8) for b, n in width.items()]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


#: What cut_repeats adds to the columns of a row.
RESULTS = ("_n_bytes", "_kept", "_n_removed", "_spans")


def _cut(docs: DataFrame, doc_id: str, text: str, length: int, gram: int, as_text: bool) -> DataFrame:
    """The columns of ``docs`` but the text as c0, c1, ..., and the results."""
    spark = docs.sparkSession
    arrow_limits(spark)
    names = [c for c in docs.columns if c != text]
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    given = docs.select(*columns, F.col(f"`{text}`").alias("t"), F.col(f"`{doc_id}`").cast("long").alias("i"))
    blocks = packed(given, "repeats-blocks")
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first().n
    n_tasks = tasks(blocks)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total * 2 // (length - gram + 1) // BUCKET_HASHES))

    def send_anchors(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        b, block = Block(rows, length, gram), asked["block"].as_py()
        value, bucket, many, times, _ = b.anchors(buckets)
        sent = [
            (block, k, pack_sorted(value[x:y]), np.packbits(many[x:y]).tobytes(), squeezed(times[x:y].astype("<u4").tobytes()))
            for k, x, y in groups(bucket)
        ]
        if sent:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*sent, strict=True)], names=["block", "bucket", "hashes", "flags", "times"])

    frequent = FREQUENT
    all_blocks = with_files(blocks, spread(blocks, n_tasks))
    sent = read_blocks(all_blocks, "block long, bucket long, hashes binary, flags binary, times binary", send_anchors)
    shared = written(
        sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(
            lambda f: _shared(f, frequent), "block long, bucket long, bits binary, often binary, alive long"
        ),
        "repeats-shared",
    )
    alive = shared.agg(F.coalesce(F.sum("alive"), F.lit(0)).alias("n")).first().n
    buckets2 = max(least, -(-alive * 64 // BUCKET_BYTES))

    def gathered(df: DataFrame, name: str, *fields: str) -> DataFrame:
        return df.groupBy("block").agg(F.collect_list(F.struct("bucket", *fields)).alias(name))

    def survivors(asked: dict, rows: pa.RecordBatch) -> Block:
        b, answers = Block(rows, length, gram), asked["known"].as_py()
        _, bucket, _, _, place = b.anchors(buckets)
        width = {k: y - x for k, x, y in groups(bucket)}
        b.keep(_by_bucket(answers, width)[place], _by_bucket(answers, width, "often")[place])
        return b

    def send_passages(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = asked["block"].as_py()
        words, bucket, low, _ = survivors(asked, rows).distinct(buckets2)
        sent = [(block, k, _pack_entries(words[x:y], low[x:y])) for k, x, y in groups(bucket)]
        if sent:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*sent, strict=True)], names=["block", "bucket", "entries"])

    known = gathered(shared, "known", "bits", "often")
    some = gathered(shared.where("alive > 0").select("block").distinct().join(shared, "block"), "known", "bits", "often")
    living = with_files(blocks, spread(blocks.join(some, "block"), n_tasks))
    passed = read_blocks(living, "block long, bucket long, entries binary", send_passages)
    judge = functools.partial(_first_documents, length=length)
    judged = written(passed.repartition(buckets2, "bucket").groupBy("bucket").applyInPandas(lambda f: judge(f), "block long, bucket long, bits binary"), "repeats-judged")

    own = given.columns[:-2]
    schema = ", ".join([f"{n} {given.schema[n].dataType.simpleString()}" for n in own] + [f"_n_bytes long, _kept {'string' if as_text else 'binary'}, _n_removed long, _spans array<struct<start:long,stop:long>>"])

    def cut(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        b = survivors(asked, rows)
        words, bucket, low, which = b.distinct(buckets2)
        n = np.array([len(w) for w in words], np.int64) - length + 1
        off = np.concatenate([[0], n.cumsum()])
        bits = _by_bucket(asked["verdicts"].as_py(), {k: int(off[y] - off[x]) for k, x, y in groups(bucket)})
        count = b.count
        inner = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count)
        gone = bits[np.repeat(off[which], count) + inner] if len(count) else np.zeros(0, bool)
        gone |= np.repeat(b.ids[b.doc] > low[which], count)
        hit = np.repeat(b.first, count)[gone] + inner[gone]
        edge = np.zeros(len(b.t) + 1, np.int32)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + length, -1)
        yield _cut_rows(b, edge.cumsum()[:-1] > 0, as_text)

    asked = blocks.join(known, "block", "left").join(gathered(judged, "verdicts", "bits"), "block", "left")
    return read_blocks(with_files(blocks, spread(asked, n_tasks)), schema, cut)


def _cut_rows(b: Block, mask: np.ndarray, as_text: bool) -> pa.RecordBatch:
    """The rows of a block without the bytes that ``mask`` marks."""
    ends = b.sizes.cumsum()
    begins = ends - b.sizes
    opening = mask.copy()
    opening[1:] &= ~mask[:-1]
    closing = mask.copy()
    closing[:-1] &= ~mask[1:]
    inside = begins[b.sizes > 0]
    opening[inside] = mask[inside]
    last = (ends - 1)[b.sizes > 0]
    closing[last] = mask[last]
    start, stop = np.flatnonzero(opening), np.flatnonzero(closing) + 1
    kept, spans, removed = [], [], []
    lo, hi = np.searchsorted(start, begins), np.searchsorted(start, ends)
    null = np.asarray(b.rows.column(b.rows.num_columns - 2).is_null())
    for i, (a, z) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        own = [(int(x), int(y)) for x, y in zip(start[lo[i] : hi[i]], stop[lo[i] : hi[i]], strict=True)] if z > a else []
        piece, at = [], a
        for x, y in own:
            piece.append(b.text[at:x])
            at = y
        piece.append(b.text[at:z])
        whole = b"".join(piece)
        kept.append(whole if not as_text else None if null[i] else whole.decode("utf-8", "ignore"))
        removed.append(sum(y - x for x, y in own))
        spans.append([{"start": x - a, "stop": y - a} for x, y in own])
    columns = b.rows.columns[:-2]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    columns += [pa.array(b.sizes), pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, kind)]
    return pa.RecordBatch.from_arrays(columns, names=[*b.rows.schema.names[:-2], *RESULTS])


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every row of ``docs`` with _n_bytes, _kept (bytes), _n_removed and _spans (starts and stops).

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
    smaller id; ids are compared as longs, and all is judged on the input.  Null texts are empty;
    rows with a null id lose nothing and take nothing from others; repeated rows of one id leave each
    other alone; texts of any length are whole; an empty table gives an empty result.  Further columns
    pass through untouched, but the results take the place of columns that have their names.
    """
    cut = _cut(docs, doc_id, text, length, gram, False)
    names = [c for c in docs.columns if c != text]
    return cut.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in RESULTS], *RESULTS)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of the text; characters cut in half go as well.

    The columns, and their order, are those of ``docs``, whatever they are called; a null text stays
    null; ``n_chars``, if there, is counted anew where there is a text.  Nulls, repeated rows and empty
    tables are as in ``cut_repeats``.
    """
    cut = _cut(docs, doc_id, text, LENGTH, GRAM, True)
    columns = {c: F.col(f"c{i}") for i, c in enumerate(c for c in docs.columns if c != text)}
    columns[text] = F.col("_kept")
    if n_chars in columns:
        columns[n_chars] = F.coalesce(F.length("_kept"), columns[n_chars]).cast(docs.schema[n_chars].dataType)
    return cut.select(*[columns[c].alias(c) for c in docs.columns])
