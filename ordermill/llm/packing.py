"""Packing into fixed windows with a sharded BM25 index.

Documents are tokenized word by word (a bounded memory of words already
seen; a word's ids never depend on its neighbours).  A document longer than a
window gives its full windows at once; what is left of it, and every shorter
document, is a remainder.  Document frequencies, the number of remainders and
their mean length are counted over the whole corpus while it is tokenized.

Remainders that share their weighty terms meet in a shard: each draws a few
terms, a term with a chance proportional to its BM25 weight, and by the same
random numbers in every document, so that like documents draw the same ones.
Sorted by the drawn terms they are cut into shards of equal numbers.  Each
shard builds an inverted index of its remainders and fills windows greedily:
the seed asks the posting lists of its terms for unused neighbours and takes
them in order of score until the window is full; the last one is cut and its
rest seeds the next window, so only the last window of a shard is padded.
"""

from __future__ import annotations

import os
import zlib
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import id_text, mix64, shuffle_partitions, staged

WINDOW, END_ID = 4096, 2
SHARD_DOCS = 1200               # remainders per shard; each is less than a window of ids
TERMS = 1 << 16                 # ids are 16-bit
DRAWS = 4                       # terms a remainder draws to find its shard
K1, B = 1.2, 0.75
CACHE_WORDS, CACHE_CHARS = 300_000, 32      # about 110 MB in a Python worker
LINE_WORDS, LINES = 64, 256     # words of a line, lines encoded at a time
PART = 1 << 23                  # bytes of text tokenized at a time
TOKENIZER = "word_bpe_49k.json"


# A word may also be cut between a letter or digit and the run of ASCII marks that ends it: no
# pre-token of the tokenizer reaches over that place, if lower-casing leaves one letter there
# (of U+0130 it leaves a combining dot).  Letters past the Latin ones are not cut: the
# tokenizer's own tables decide what they are.  Words that may hold a special token stay whole.
LAST_LATIN, SPECIAL = "\u024f", "<|"
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
BLANKS = " \t\n\r"
_BLANK, _MARK, _PLAIN = 1, 2, 3
_KINDS = bytes(_BLANK if c in BLANKS else _MARK if c in MARKS else _PLAIN if c.isascii() and c.isalnum() else 0
               for c in map(chr, range(256)))


class Words:
    """ids of words as 16-bit bytes; lives as long as its Python worker."""

    loaded: dict = {}

    def __init__(self, path):
        self.known = {"": b""}          # an exact dict: set differences against it stay cheap
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        assert self.tokenizer.get_vocab_size() <= 1 << 16
        self.last = self.endings(self.tokenizer)

    @classmethod
    def of(cls, path):
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    @staticmethod
    def endings(tokenizer):
        """Whether an id ends a pre-token (by id): each pre-token of one or more bytes has one such id, its
        last.  None for tokenizers that do not tell."""
        from tokenizers.pre_tokenizers import ByteLevel
        suffix, vocab = getattr(tokenizer.model, "end_of_word_suffix", None), tokenizer.get_vocab()
        if not suffix or not all(c + suffix in vocab for c in ByteLevel.alphabet()):
            return None
        last = np.zeros(1 << 16, bool)
        last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return last

    @staticmethod
    def core(word):
        """(word without the marks that end it, those marks); letters are lower-cased anyway."""
        if word.isalpha():
            return word.lower() if word.isascii() else word, ""
        if SPECIAL in word:
            return word, ""
        if word.isascii():
            word = word.lower()
        core = word.rstrip(MARKS)
        last = core[-1:].lower()
        whole = len(last) == 1 and last <= LAST_LATIN and last.isalnum()
        return (core, word[len(core):]) if whole else (word, "")

    def encoded(self, words):
        """{word: ids}; words that hold no special token are encoded many at a time, a blank
        between them.  Words of letters are one pre-token each, as a rule: a line with as many
        pre-tokens as words is told apart by the ids that end them, any other by the places
        its ids come from."""
        letters = [w for w in words if w.isalpha()] if self.last is not None else []
        found, placed = {}, []
        for lo in range(0, len(letters), LINE_WORDS * LINES):
            lines = [letters[i:i + LINE_WORDS] for i in range(lo, min(lo + LINE_WORDS * LINES, len(letters)), LINE_WORDS)]
            for line, e in zip(lines, self.tokenizer.encode_batch_fast(list(map(" ".join, lines)), add_special_tokens=False)):
                ids = array("H", e.ids)
                cut = (2 * np.flatnonzero(self.last[np.frombuffer(ids, np.uint16)]) + 2).tolist()
                if len(cut) == len(line):
                    ids = ids.tobytes()
                    found.update((w, ids[a:b]) for w, a, b in zip(line, [0, *cut], cut))
                else:
                    placed += line
        placed += [w for w in words if not w.isalpha() or self.last is None]
        plain = [w for w in placed if SPECIAL not in w]
        lines = [plain[i:i + LINE_WORDS] for i in range(0, len(plain), LINE_WORDS)]
        lines += [[w] for w in placed if SPECIAL in w]
        for lo in range(0, len(lines), LINES):
            some = lines[lo: lo + LINES]
            for line, e in zip(some, self.tokenizer.encode_batch(list(map(" ".join, some)), add_special_tokens=False)):
                begin = np.cumsum([0] + [len(w) + 1 for w in line])
                cut = np.searchsorted([a for a, _ in e.offsets], begin).tolist()
                ids = array("H", e.ids).tobytes()
                found.update((w, ids[2 * a: 2 * b]) for w, a, b in zip(line, cut, cut[1:]))
        return found

    @staticmethod
    def words(texts):
        """(words of all texts as a dictionary array, words up to the end of each text).  Words begin at
        ASCII blanks and line ends, over which no pre-token reaches; the marks that end a word after a
        plain letter or digit (see ``core``) are words of their own."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1, dtype=np.int64)
        raw = b" " + pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), " ")[0].as_buffer().to_pybytes()
        kind = np.frombuffer((raw + b" ").translate(_KINDS), np.uint8)     # the blank after it ends the last run
        start = kind[:-1] == _BLANK
        mark = kind == _MARK
        turn = np.flatnonzero(mark[1:] != mark[:-1]) + 1    # runs of marks begin and end
        run, after = turn[::2], turn[1::2]
        run = run[(kind[run - 1] == _PLAIN) & (kind[after] == _BLANK)]
        if SPECIAL.encode() in raw:
            first, data = np.flatnonzero(start), np.frombuffer(raw, np.uint8)
            special = np.flatnonzero((data[:-1] == ord(SPECIAL[0])) & (data[1:] == ord(SPECIAL[1])))
            whole = np.searchsorted(first, special, "right")
            run = run[~np.isin(np.searchsorted(first, run, "right"), whole)]
        start[run] = True
        begin = np.flatnonzero(start)
        blanks = np.cumsum(np.r_[0, kind[begin] == _BLANK], dtype=np.int64)
        place = (np.r_[begin, len(raw)] - blanks).astype(np.int32)              # without the blanks
        letters = raw.translate(None, BLANKS.encode())
        words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(place), pa.py_buffer(letters))
        return words.dictionary_encode(), np.searchsorted(begin, ends)

    def ids(self, texts):
        """16-bit ids (bytes) of each text (a list, or an Arrow array)."""
        if not len(texts):
            return []
        known = self.known
        found, ends = self.words(texts)
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = list(map(known.get, words))
        if None in codes:
            missing = [i for i, c in enumerate(codes) if c is None]
            parts = {w: self.core(w) for w in {words[i] for i in missing}}
            cores = list({c for p in parts.values() for c in p}.difference(known))
            fresh = self.encoded(cores)
            whole = {w: (fresh[c] if c in fresh else known[c]) + (fresh[m] if m in fresh else known[m])
                     for w, (c, m) in parts.items()}
            for i in missing:
                codes[i] = whole[words[i]]
            fresh.update(whole)
            known.update(islice(((w, c) for w, c in fresh.items() if len(w) <= CACHE_CHARS), max(CACHE_WORDS - len(known), 0)))
        ids, count = np.frombuffer(b"".join(codes), "<u2"), np.fromiter(map(len, codes), np.int64, len(codes)) // 2
        code = found.indices.to_numpy()
        n, begin = count[code], (np.cumsum(count) - count)[code]
        to = np.cumsum(n)
        at = np.repeat((begin - to + n).astype(np.int32), n)            # a part has far fewer than 2^31 ids
        at += np.arange(len(at), dtype=np.int32)
        out = ids[at].tobytes()
        ends = np.r_[0, 2 * to][ends].tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends)]


def _crc(ids: bytes) -> int:
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


PIECE = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_NAMES = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"]
COUNTS = -1                     # ``start`` of the row that holds a partition's counts


def _rows(rows, types, names):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _postings(ids):
    """(document, term, occurrences) of up to 2^16 remainders, by document and term;
    the end mark, last in each, is no term."""
    flat = np.frombuffer(b"".join(x[:-2] for x in ids), "<u2")
    doc = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(x) // 2 - 1 for x in ids])
    key = doc << np.uint32(16) | flat
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.r_[first, len(key)]).astype(np.float32)
    return (key[first] >> np.uint32(16)).astype(np.int64), (key[first] & np.uint32(TERMS - 1)).astype(np.int64), tf


class Statistics:
    """Counts of a corpus of remainders, and the BM25 weights they give."""

    def __init__(self, docs: int, tokens: int, df: np.ndarray):
        self.mean = max(tokens / docs, 1) if docs else 1
        self.idf = np.log(1 + (docs - df + 0.5) / (df + 0.5)).astype(np.float32)

    @classmethod
    def of(cls, ids):
        return cls(len(ids), sum(len(x) // 2 for x in ids), np.bincount(_postings(ids)[1], minlength=TERMS))

    def weights(self, ids, doc, term, tf):
        size = np.array([len(x) // 2 for x in ids], np.float32)
        norm = (K1 * (1 - B + B * size / self.mean)).astype(np.float32)
        return self.idf[term] * tf * np.float32(K1 + 1) / (tf + norm[doc])


def _parts(batch):
    """Slices of a batch of about ``PART`` bytes of text each, and at most 2^15 rows."""
    size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = np.searchsorted(size, np.arange(PART, size[-1] if len(size) else 0, PART))
    at = np.unique(np.r_[0, at, np.arange(0, batch.num_rows, 1 << 15), batch.num_rows]).tolist()
    return [batch.slice(a, b - a) for a, b in zip(at, at[1:])]


def _tokenize(path, end_id, window, keep_ids):
    tail = np.array([end_id], "<u2").tobytes()

    def run(batches):
        words = Words.of(path)
        docs, tokens, df = 0, 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for part in _parts(batch):
                out, rest = [], []
                for doc, ids in zip(part.column("doc_id").to_pylist(), words.ids(part.column("text"))):
                    ids += tail
                    n = len(ids) // 2
                    whole = n - n % window
                    for at in range(0, whole, window):
                        piece = ids[2 * at: 2 * (at + window)]
                        out.append((doc, at, window, n, _crc(piece), piece if keep_ids else None))
                    if whole < n:
                        rest.append(ids[2 * whole:])
                        out.append((doc, whole, n - whole, n, None, rest[-1]))
                docs, tokens = docs + len(rest), tokens + sum(len(x) // 2 for x in rest)
                df += np.bincount(_postings(rest)[1], minlength=TERMS)
                yield _rows(out, _TYPES, _NAMES)
        if docs:
            yield _rows([(None, COUNTS, docs, tokens, None, df.astype("<i8").tobytes())], _TYPES, _NAMES)
    return run


def _counted(batches):
    """(term, remainders that hold it) of the counts of each partition; term -1: remainders, -2: tokens."""
    for batch in batches:
        for docs, tokens, counts in zip(*[batch.column(c).to_pylist() for c in ("length", "doc_tokens", "ids")]):
            df = np.frombuffer(counts, "<i8")
            term = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, term].astype(np.int32)),
                                              pa.array(np.r_[docs, tokens, df[term]])], names=["term", "n"])


def _statistics(pieces: DataFrame) -> tuple[int, Statistics]:
    """(remainders, statistics) of the corpus; the driver gets one row per term of the vocabulary."""
    counts = pieces.where(F.col("start") == COUNTS).mapInArrow(_counted, "term int, n long")
    total = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    docs, tokens = total.pop(-1, 0), total.pop(-2, 0)
    df = np.zeros(TERMS, np.int64)
    df[list(total)] = list(total.values())
    return docs, Statistics(docs, tokens, df)


def _clocks():
    """Waiting times of every term, one row per draw: exponential, the same in every task."""
    at = np.arange(1, DRAWS * TERMS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        h = mix64(mix64(at))
    return -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53).reshape(DRAWS, TERMS).astype(np.float32)


def draws(ids, stats: Statistics, clocks) -> np.ndarray:
    """The terms each remainder draws (a row each): that of the shortest waiting time, where a
    term's time is its clock's divided by its weight; -1 where there is no term."""
    doc, term, tf = _postings(ids)
    weight = np.maximum(stats.weights(ids, doc, term, tf), np.float32(1e-9))
    start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    out = np.full((len(ids), DRAWS), -1, np.int64)
    for i in range(DRAWS if len(doc) else 0):
        time = clocks[i][term] / weight
        least = np.repeat(np.minimum.reduceat(time, start), np.diff(np.r_[start, len(doc)]))
        won = np.flatnonzero(time == least)[::-1]             # of equal times the smallest term
        out[doc[won], i] = term[won]
    return out


ROUTE = [f"draw{i}" for i in range(DRAWS)]


def _route(stats):
    """Pieces with the terms they draw, and a salt that spreads pieces alike in everything."""
    def run(batches):
        clocks, row = _clocks(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                salt = mix64(np.arange(row, row + part.num_rows, dtype=np.uint64)).astype(np.int64)
                row += part.num_rows
                full = np.array([c is not None for c in part.column("ids_crc32").to_pylist()])
                drawn = np.full((part.num_rows, DRAWS), -1, np.int64)
                drawn[full, 0] = salt[full] & (TERMS - 1)     # windows that are full already go anywhere
                drawn[~full] = draws(part.column("ids").filter(pa.array(~full)).to_pylist(), stats, clocks)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(c) for c in drawn.T], pa.array(salt)], names=[*_NAMES, *ROUTE, "salt"])
    return run


class Index:
    """Inverted index of a shard's remainders: a list of (document, BM25 part) per term.  Lists that
    name more than every fourth document are kept as rows of a part per document instead."""

    def __init__(self, ids, stats: Statistics | None = None):
        doc, term, tf = _postings(ids)
        weight = (stats or Statistics.of(ids)).weights(ids, doc, term, tf)
        wide = np.bincount(term, minlength=TERMS) > len(ids) / 4
        self.row = np.where(wide, np.cumsum(wide) - 1, -1)
        self.wide = np.zeros((int(wide.sum()), len(ids)), np.float32)
        at = wide[term]
        self.wide[self.row[term[at]], doc[at]] = weight[at]
        doc, term, weight = doc[~at], term[~at], weight[~at]
        order = np.argsort(term, kind="stable")
        self.docs, self.doc, self.weight = len(ids), doc[order], weight[order].astype(np.float64)
        self.start = np.searchsorted(term[order], np.arange(TERMS + 1))

    def neighbours(self, ids: bytes, free: np.ndarray) -> np.ndarray:
        """Free documents sharing a term (the end mark, last in ``ids``, is none), best score
        first, ties to the earlier one."""
        asked = np.zeros(TERMS, bool)
        asked[np.frombuffer(ids, "<u2")[:-1]] = True
        terms = np.flatnonzero(asked)
        rows = self.row[terms]
        ask = np.zeros(len(self.wide), np.float32)
        ask[rows[rows >= 0]] = 1
        score = (ask @ self.wide).astype(np.float64)
        first, last = self.start[terms], self.start[terms + 1]
        lists = [slice(a, b) for a, b in zip(first.tolist(), last.tolist()) if a < b]
        if lists:
            score += np.bincount(np.concatenate([self.doc[s] for s in lists]),
                                 np.concatenate([self.weight[s] for s in lists]), self.docs)
        hit = np.flatnonzero((score > 0) & free)
        return hit[np.argsort(-score[hit], kind="stable")]


def _fill(rest, stats, window, keep_ids, seq):
    """(pieces, next sequence) of a shard: ``rest`` has (doc_id, start, doc_tokens, ids) per remainder."""
    ids = [r[3] for r in rest]
    index, free, out = Index(ids, stats), np.ones(len(rest), bool), []
    used = 0                                # tokens in the open window

    def place(r, at, n):
        """Piece of remainder ``r`` from its token ``at``."""
        nonlocal used, seq
        doc, start, size, _ = rest[r]
        piece = ids[r][2 * at: 2 * (at + n)]
        out.append((doc, start + at, n, _crc(piece), size, seq, used, piece if keep_ids else None))
        used += n
        if used == window:
            seq, used = seq + 1, 0

    at_seed, cut = 0, None                  # cut: (remainder, tokens of it already placed)
    while True:
        if cut is not None:
            seed, done = cut
            cut = None
        else:
            while at_seed < len(rest) and not free[at_seed]:
                at_seed += 1
            if at_seed == len(rest):
                break
            seed, done = at_seed, 0
            free[seed] = False
        left = len(ids[seed]) // 2 - done
        room = window - used
        place(seed, done, min(left, room))
        if left > room:
            cut = (seed, done + room)
            continue
        if not used:
            continue
        for r in index.neighbours(ids[seed], free).tolist():
            free[r] = False
            n, room = len(ids[r]) // 2, window - used
            place(r, 0, min(n, room))
            if n > room:
                cut = (r, room)
            if not used:
                break
    return out, seq + (used > 0)


def _pack(stats, window, keep_ids):
    """Shards are cut from the sorted rows as they come; sequences are numbered by partition."""
    types = [pa.int64()] * 7 + [pa.binary()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    columns = 8 if keep_ids else 7

    def run(batches):
        seq, rest = TaskContext.get().partitionId() << 40, []
        for batch in batches:
            out = []
            for doc, start, n, size, crc, ids in zip(*[batch.column(c).to_pylist() for c in _NAMES]):
                if crc is not None:
                    out.append((doc, start, n, crc, size, seq, 0, ids))
                    seq += 1
                    continue
                rest.append((doc, start, size, ids))
                if len(rest) == SHARD_DOCS:
                    filled, seq = _fill(rest, stats, window, keep_ids, seq)
                    out, rest = out + filled, []
            if out:
                yield _rows([r[:columns] for r in out], types, names[:columns])
        if rest:
            out, seq = _fill(rest, stats, window, keep_ids, seq)
            yield _rows([r[:columns] for r in out], types, names[:columns])
    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col="doc_id", text_col="text", end_id: int = END_ID,
         window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ``ids``, little-endian 16-bit, on request).

    Null and empty texts are one end id.  Repeated rows are packed once each;
    a null id stays null.  An empty table gives an empty result."""
    d = id_text(docs, id_col, text_col)
    pieces = staged(d.mapInArrow(_tokenize(tokenizer_path, end_id, window, keep_ids), PIECE), "packing-pieces")
    remainders, stats = _statistics(pieces)
    parts = min(remainders // SHARD_DOCS + 1, shuffle_partitions(d.sparkSession))
    routed = pieces.where(F.col("start") != COUNTS).mapInArrow(
        _route(stats), PIECE + ", " + ", ".join(f"{c} long" for c in ROUTE) + ", salt long")
    placed = routed.repartitionByRange(parts, *ROUTE, "salt").sortWithinPartitions(*ROUTE, "salt")
    return placed.select(*_NAMES).mapInArrow(
        _pack(stats, window, keep_ids), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + (", ids binary" if keep_ids else ""))
