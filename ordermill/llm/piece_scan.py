"""SentencePiece encoding and decoding with a max-plus parallel scan.

The vocabulary's pieces and scores define the best segmentation: the one of
highest total score (a piece's score, or a fixed low one for a character that
has no piece and is spelled in bytes).  Scores are integers, with a tiny
fixed tie-breaking part per piece, so sums are exact and the best
segmentation is, but for equal sums, unique.

Giant documents are cut into chunks of at most ``CHUNK`` characters: before a
blank if one is near, else anywhere.  The state at a border is how many
characters the piece that crosses it reaches over.  Each chunk yields a matrix: best score from each entry state to each
exit state.  Matrices combine associatively under (max, +); the running
products give the state at every border, and then every chunk is traced back
on its own.  Inside a chunk, text is cut wherever two bytes meet that lie side by
side in no piece; what is between the cuts is segmented once, many such texts
at a time, and remembered.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import id_text, shuffle_partitions

CHUNK = 1 << 15
MODEL = "piece_bpe_32k.model"
SHIFT = 24                  # bits below a score for the tie-breaking part
NONE, ONLY = -(1 << 62), 1
LEAST_SCORE = -(1 << 17)    # scores below it ("never") count as it, so sums of a chunk fit 62 bits
CACHE, CACHE_CHARS = 450_000, 32
PART = 1 << 22              # bytes of text segmented at a time
# A piece may begin with blanks but has none after another character, and no line end (checked on load).
BORDER, NEAR = re.compile(r"[^ ](?= )"), 1024
SPACE = "▁"            # how the vocabulary writes a blank


class Vocabulary:
    """Pieces (blanks as blanks), weights, byte ids; remembers segmented text
    as long as its Python worker lives."""

    loaded: dict = {}

    @classmethod
    def of(cls, path):
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def __init__(self, path):
        import sentencepiece
        import xxhash
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.text, self.byte = {}, {}, {}
        weights = {}
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = sp.id_to_piece(i).replace(SPACE, " ")
                self.ids[piece], self.text[i] = i, piece.encode()
                weights[piece] = (max(round(sp.get_score(i)), LEAST_SCORE) << SHIFT) - xxhash.xxh64_intdigest(piece) % 251
        assert len(self.byte) == 256
        self.text.update({i: bytes([b]) for b, i in self.byte.items()})
        self.unknown = min(weights.values()) - (10 << SHIFT)
        self.longest = max(map(len, weights))
        assert not any(re.search(r"[^ ] |\n", p) for p in weights)
        # weight of every piece; ONLY for beginnings of pieces that are none themselves
        steps = {p[:i]: ONLY for p in weights for i in range(1, len(p))}
        steps.update(weights)
        self.steps = steps
        self.weights, self.cache = weights, {}
        self.apart = np.ones((256, 256), bool)              # bytes side by side in no piece
        for p in weights:
            b = np.frombuffer(p.encode(), np.uint8)
            self.apart[b[:-1], b[1:]] = False
        self.apart[:, 0x80:0xC0] = False                    # inside a character
        self._trie()

    def _trie(self):
        """The beginnings of pieces as nodes; an edge lies in the table at its node's base plus its
        character's class, and names its node there.  Class 0 is on no edge."""
        node = {p: i for i, p in enumerate(["", *self.steps])}
        chars = sorted({p[-1] for p in self.steps})
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        edges = {}
        for p, i in node.items():
            if p:
                edges.setdefault(node[p[:-1]], []).append((int(self.classes[ord(p[-1])]), i))
        self.base = np.zeros(len(node), np.int64)
        slots = 4 * len(node)
        self.owner, self.child = np.full(slots + len(chars) + 1, -1, np.int32), np.zeros(slots + len(chars) + 1, np.int32)
        places = np.random.default_rng(7)
        for i in sorted(edges, key=lambda i: -len(edges[i])):
            at, to = map(np.array, zip(*edges[i]))
            while (self.owner[(base := int(places.integers(slots))) + at] >= 0).any():
                pass
            self.base[i], self.owner[base + at], self.child[base + at] = base, i, to
        self.worth = np.array([NONE, *[NONE if w == ONLY else w for w in self.steps.values()]])
        self.piece = np.array([-1, *[self.ids.get(p, -1) for p in self.steps]], np.int32)
        self.alone = np.array([True, *[c not in self.weights for c in chars]])      # by class: characters without a piece

    def forward(self, text, start, reach=0):
        """Best weights and previous places at each position from ``start`` weights
        (place -> weight); pieces begin before ``len(text) - reach``."""
        n = len(text)
        best, back = [NONE] * (n + 1), [-1] * (n + 1)
        for at, w in start.items():
            best[at] = w
        step = self.steps.get
        for i in range(n - reach):
            w = best[i]
            if w == NONE:
                continue
            s = step(text[i])
            if s is None or s == ONLY:
                if w + self.unknown > best[i + 1]:
                    best[i + 1], back[i + 1] = w + self.unknown, i
                if s is None:
                    continue
            elif w + s > best[i + 1]:
                best[i + 1], back[i + 1] = w + s, i
            for j in range(i + 2, n + 1):
                s = step(text[i:j])
                if s is None:
                    break
                if s != ONLY and w + s > best[j]:
                    best[j], back[j] = w + s, i
        return best, back

    def trace(self, text, back, stop, start=0):
        cuts = [stop]
        while cuts[-1] > start:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        out = []
        for a, b in zip(cuts, cuts[1:]):
            i = self.ids.get(text[a:b])
            out.extend((i,) if i is not None else [self.byte[x] for x in text[a:b].encode()])
        return np.array(out, "<u2").tobytes()

    def segment(self, text):
        """(ids as 16-bit bytes, weight) of text that no piece crosses at either end."""
        known = self.cache.get(text)
        if known is None:
            best, back = self.forward(text, {0: 0})
            known = (self.trace(text, back, len(text)), best[-1])
            if len(text) <= CACHE_CHARS and len(self.cache) < CACHE:
                self.cache[text] = known
        return known

    def _solved(self, texts):
        """What ``segment`` gives for each of many short texts, found side by side: places in
        order, at each the pieces that begin there by length, so equal sums end alike."""
        texts = sorted(texts, key=len, reverse=True)
        size = np.array(list(map(len, texts)))
        n, longest = len(texts), int(size[0])
        code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        place = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
        chars = np.zeros((longest, n), np.int32)
        chars[place, np.repeat(np.arange(n), size)] = self.classes[code]
        best = np.full((longest + 1, n), NONE)
        back, piece = np.zeros((longest + 1, n), np.int32), np.full((longest + 1, n), -1, np.int32)
        best[0] = 0
        for i in range(longest):
            m = int(np.searchsorted(-size, -i))             # texts longer than i
            start, at, node = best[i], np.arange(m), np.zeros(m, np.int64)
            won = np.flatnonzero(self.alone[chars[i, :m]] & (start[:m] + self.unknown > best[i + 1, :m]))
            best[i + 1, won], back[i + 1, won], piece[i + 1, won] = start[won] + self.unknown, i, -1
            for j in range(i, longest):
                slot = self.base[node] + chars[j, at]
                on = np.flatnonzero(self.owner[slot] == node)
                if not len(on):
                    break
                at, node = at[on], self.child[slot[on]].astype(np.int64)
                worth = self.worth[node]
                sums = start[at] + worth
                won = np.flatnonzero((worth != NONE) & (sums > best[j + 1, at]))
                to = at[won]
                best[j + 1, to], back[j + 1, to], piece[j + 1, to] = sums[won], i, self.piece[node[won]]
        steps, at, place = [], np.arange(n), size
        spelled = np.zeros(n, bool)                         # has a character spelled in bytes
        while len(at):
            found = piece[place, at]
            spelled[at[found < 0]] = True
            steps.append((at, found))
            place = back[place, at]
            at, place = at[place > 0], place[place > 0]
        count = np.bincount(np.concatenate([a for a, _ in steps]), minlength=n)
        end = np.cumsum(count)
        out = np.zeros(int(end[-1]), "<u2")
        for k, (a, found) in enumerate(steps):
            out[end[a] - 1 - k] = found
        out, end = out.tobytes(), (2 * end).tolist()
        total = best[size, np.arange(n)].tolist()
        known = {t: (out[a:b], w) for t, a, b, w in zip(texts, [0, *end], end, total)}
        known.update([(texts[i], self.segment(texts[i])) for i in np.flatnonzero(spelled).tolist()])
        return known

    def segments(self, texts):
        """For each of some texts that no piece crosses at either end: (ids, weight); ids as 16-bit bytes."""
        rows, part, size = [], [], 0
        for t in texts:
            part.append(t.encode())
            size += len(part[-1])
            if size >= PART:
                rows += self._segments(part)
                part, size = [], 0
        return rows + self._segments(part)

    def _segments(self, texts):
        size = np.array(list(map(len, texts)), np.int64)
        ends = np.cumsum(size)
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return [(b"", 0)] * len(texts)
        cut = self.apart[data[:-1], data[1:]]
        cut[ends[(ends > 0) & (ends < len(data))] - 1] = True
        first = np.r_[0, np.flatnonzero(cut) + 1, len(data)].astype(np.int32)
        words = pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(first), pa.py_buffer(data)).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.cache.get, distinct))
        new = [w for w, f in zip(distinct, found) if f is None]
        solved = self._solved(short) if (short := [w for w in new if len(w) <= CACHE_CHARS]) else {}
        if len(self.cache) < CACHE:
            self.cache.update(solved)
        found = [f or solved.get(w) or self.segment(w) for w, f in zip(distinct, found)]
        ids = np.frombuffer(b"".join([f[0] for f in found]), "<u2")
        count = np.array([len(f[0]) // 2 for f in found])
        code = words.indices.to_numpy()
        n, begin = count[code], (np.cumsum(count) - count)[code]
        to = np.cumsum(n)
        out = ids[np.repeat(begin - to + n, n) + np.arange(int(to[-1]))].tobytes()
        weight = np.cumsum(np.array([f[1] for f in found])[code])      # may wrap; a text's own does not
        word = np.searchsorted(first, ends)                 # words up to each text's end
        at, sums = np.r_[0, 2 * to][word].tolist(), np.r_[0, weight][word]
        return [(out[a:b], w) for a, b, w in zip([0, *at], at, np.diff(sums, prepend=0).tolist())]

    def encode(self, text):
        return self.segments([text])[0][0]

    def _ends(self, text, n):
        """First and last places of ``text[:n]`` (past the longest entry state) no piece crosses."""
        low = self.longest
        first = BORDER.search(text, low, n)
        if not first:
            return None
        a = first.end()
        b = max(a, text.rfind(" ", a, n))
        while b > a and text[b - 1] == " ":                 # the blanks begin here
            b -= 1
        return a, b

    def matrix(self, text, n):
        """Best weight from entry state e to exit state f of chunk ``text[:n]``;
        ``text`` goes on for the characters an exit piece may take."""
        size = self.longest
        out = np.full((size, size), NONE, np.int64)
        over = len(text) - n
        ends = self._ends(text, n)
        if ends is None:
            for e in range(min(size, n + 1)):
                best, _ = self.forward(text, {e: 0}, over)
                for f, w in enumerate(best[n: n + size]):
                    out[e, f] = w
            return out
        a, b = ends
        middle = self.segments([text[a:b]])[0][1]
        tail = self.forward(text[b:], {0: 0}, over)[0][n - b: n - b + size]
        for e in range(size):
            head = self.forward(text[:a], {e: 0})[0][a]
            if head != NONE:
                for f, w in enumerate(tail):
                    if w != NONE:
                        out[e, f] = head + middle + w
        return out

    def between(self, text, n, enter, leave):
        """ids of chunk ``text[:n]`` from entry state to exit state."""
        ends = self._ends(text, n)
        if ends is None:
            best, back = self.forward(text[: n + leave], {enter: 0}, leave)
            return self.trace(text, back, n + leave, enter)
        a, b = ends
        head = self.trace(text, self.forward(text[:a], {enter: 0})[1], a, enter)
        last = text[b: n + leave]
        return head + self.encode(text[a:b]) + self.trace(last, self.forward(last, {0: 0}, leave)[1], len(last))

    def decode(self, ids: bytes) -> str:
        """Text of ids, the leading blank of encoding included."""
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u2").tolist())).decode()


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; entries below half of NONE mean "no path"."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return np.where(out < NONE // 2, NONE, out)


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """State at each border, ends included (0), on the best path through all chunks."""
    forward = [np.where(np.arange(len(matrices[0])) == 0, 0, NONE)]
    for m in matrices:
        v = (forward[-1][:, None] + m).max(axis=0)
        v = np.where(v < NONE // 2, NONE, v - v.max())      # only differences matter
        forward.append(v)
    states = [0]
    for v, m in zip(reversed(forward[:-1]), reversed(matrices)):
        states.append(int(np.argmax(v + m[:, states[-1]])))
    return states[::-1]


def _row(vocab, doc, key, no, text, n, ids, enter, leave):
    start = 1 if no == 0 else 0                             # the blank put before the text
    covered = text[max(enter, 0): n + leave]
    back = vocab.decode(ids)
    return (doc, key, no, len(ids) // 2, zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes()),
            len(covered) - start, back == covered, ids)


_OUT = [("doc_id", pa.int64()), ("key", pa.int64()), ("chunk", pa.int32()), ("n_ids", pa.int64()),
        ("ids_crc32", pa.int64()), ("n_chars", pa.int64()), ("round_trip", pa.bool_()), ("ids", pa.binary())]
OUT = "doc_id long, key long, chunk int, n_ids long, ids_crc32 long, n_chars long, round_trip boolean, ids binary"


def _batch(rows):
    cols = list(zip(*rows)) or [[]] * len(_OUT)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _OUT)], names=[n for n, _ in _OUT])


def _whole(path):
    def run(batches):
        vocab = Vocabulary.of(path)
        for b in batches:
            texts = [" " + t for t in b.column("text").to_pylist()]
            yield _batch([_row(vocab, doc, key, 0, text, len(text), ids, 0, 0) for doc, key, text, (ids, _) in zip(
                b.column("doc_id").to_pylist(), b.column("key").to_pylist(), texts, vocab.segments(texts))])
    return run


def _cut(chunk, over):
    def run(batches):
        for b in batches:
            for doc, key, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                text = " " + text
                at = [0]
                while len(text) - at[-1] > chunk:
                    end = at[-1] + chunk
                    near = [m.start() + 1 for m in BORDER.finditer(text, end - min(NEAR, chunk // 2), end + 1)]
                    at.append(near[-1] if near else end)
                size = [b - a for a, b in zip(at, [*at[1:], len(text)])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(at), pa.int64()), pa.array([key] * len(at), pa.int64()),
                     pa.array(range(len(at)), pa.int32()), pa.array(size, pa.int32()),
                     pa.array([text[i: i + n + over] for i, n in zip(at, size)], pa.string())],
                    names=["doc_id", "key", "chunk", "size", "text"])
    return run


def _matrices(path):
    def run(batches):
        vocab = Vocabulary.of(path)
        for b in batches:
            m = [vocab.matrix(t, n).tobytes() for t, n in zip(b.column("text").to_pylist(), b.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "key", "chunk")] + [pa.array(m, pa.binary())],
                                             names=["doc_id", "key", "chunk", "matrix"])
    return run


def _states(table):
    table = table.sort_by("chunk")
    chunks = table.column("chunk").to_pylist()
    first = [i for i, c in enumerate(chunks) if i == 0 or c != chunks[i - 1]]      # equal rows of a document are equal
    found = table.column("matrix").to_pylist()
    found = [np.frombuffer(found[i], np.int64) for i in first]
    size = int(round(len(found[0]) ** 0.5))
    states = border_states([m.reshape(size, size) for m in found])
    return pa.table({"doc_id": table.column("doc_id").take(first), "key": table.column("key").take(first),
                     "chunk": table.column("chunk").take(first),
                     "enter": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})


def _traced(path):
    def run(batches):
        vocab = Vocabulary.of(path)
        for b in batches:
            yield _batch([_row(vocab, d, k, c, t, n, vocab.between(t, n, e, f), e, f) for d, k, c, t, n, e, f in zip(
                *(b.column(x).to_pylist() for x in ("doc_id", "key", "chunk", "text", "size", "enter", "leave")))])
    return run


def encode(docs: DataFrame, model_path: str, id_col="doc_id", text_col="text", chunk: int = CHUNK,
           longest: int = 16) -> DataFrame:
    """One row per chunk of a document (one for all but giant ones): doc_id, key
    (code of the text), chunk, n_ids, ids_crc32 (little-endian 32-bit ids),
    n_chars, round_trip (the ids decode to exactly the chunk's text), ids
    (little-endian 16-bit).  The ids of a document are its chunks' ids in order.

    Null text is empty text (its ids spell the leading blank).  Rows of equal
    id and text get equal rows each.  An empty table gives an empty result."""
    d = id_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    size = F.length("text") + 1
    small = d.where(size <= chunk).mapInArrow(_whole(model_path), OUT)
    cut = (d.where(size > chunk).mapInArrow(_cut(chunk, longest), "doc_id long, key long, chunk int, size int, text string")
           .repartition(shuffle_partitions(docs.sparkSession), "doc_id", "key", "chunk"))
    matrices = cut.mapInArrow(_matrices(model_path), "doc_id long, key long, chunk int, matrix binary")
    states = matrices.groupBy("doc_id", "key").applyInArrow(
        _states, "doc_id long, key long, chunk int, enter int, leave int")
    states = states.select(*[F.col(c).alias(f"s_{c}") for c in ("doc_id", "key", "chunk")], "enter", "leave")
    placed = cut.join(states, cut["doc_id"].eqNullSafe(states["s_doc_id"]) & (cut["key"] == states["s_key"])
                      & (cut["chunk"] == states["s_chunk"]))
    large = placed.select("doc_id", "key", "chunk", "text", "size", "enter", "leave").mapInArrow(_traced(model_path), OUT)
    return small.unionByName(large)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, key, chunk, text of rows as ``encode`` returns them; the chunks'
    texts in order are the document's text."""
    def run(batches):
        vocab = Vocabulary.of(model_path)
        for b in batches:
            texts = [vocab.decode(i)[c == 0:] for i, c in zip(b.column("ids").to_pylist(), b.column("chunk").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "key", "chunk")]
                                             + [pa.array(texts, pa.string())], names=["doc_id", "key", "chunk", "text"])
    return encoded.select("doc_id", "key", "chunk", "ids").mapInArrow(
        run, "doc_id long, key long, chunk int, text string")
