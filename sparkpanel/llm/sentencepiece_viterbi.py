"""SentencePiece encoding and decoding by a batched numpy Viterbi.

The segmentation of a text is the one whose pieces' scores have the largest sum, over the
pieces and scores of a SentencePiece model file; ties take the longer last piece.  That is
SentencePiece's unigram search.  (For a file whose own algorithm is BPE the scores are
merge ranks, and merging pair by pair may end elsewhere: this operator searches the best
sum under the file's scores and does not imitate the merges.)

Texts are cut into words where no piece can cross, as the vocabulary itself shows: two
neighbouring characters stay together only if some piece holds characters that chain them
up, and a word begins before a ``▁`` that follows anything else (a vocabulary with pieces
across that boundary is searched as whole texts).  The distinct words of a batch are
grouped by length and advance together: at every end position and for every piece length,
64-bit hashes of all words' substrings probe the sorted hashes of the pieces of that
length, hits are confirmed by their characters, and vectorised maxima store the best score
and the backpointer.  Characters that no piece covers become byte pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: ids of distinct words kept by a worker, words searched in one block
_CACHE, _BLOCK = 500_000, 20_000
#: score of a character without a piece, below the lowest piece by this much
_UNKNOWN_GAP = 10.0


class Model:
    """Pieces of a model file, indexed by length: sorted hashes, ids, scores, characters."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        self.byte_of = np.full(n, -1, dtype=np.int64)
        silent = set()
        by_length: dict[int, list[int]] = {}
        scores = np.array([sp.get_score(i) for i in range(n)])
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or " " in piece:
                silent.add(i)
            else:
                by_length.setdefault(len(piece), []).append(i)
        self.bytes_of = [b"" if i in silent else bytes([self.byte_of[i]]) if self.byte_of[i] >= 0 else
                         p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.has_bytes = bool((self.byte_ids >= 0).all())
        normal = [i for ids in by_length.values() for i in ids]
        self.unknown_score = float(scores[normal].min()) - _UNKNOWN_GAP
        self.word = self._word_pattern({p[k:k + 2] for p in (self.pieces[i] for i in normal) for k in range(len(p) - 1)})
        self.tables = {}
        for length, ids in by_length.items():
            ids = np.array(ids, dtype=np.int64)
            chars = np.array([[ord(c) for c in self.pieces[i]] for i in ids], dtype=np.uint32)
            hashes = hash_rows(chars)
            order = np.argsort(hashes, kind="stable")
            if len(np.unique(hashes)) != len(hashes):
                raise ValueError("two pieces of one length share a hash")
            self.tables[length] = (hashes[order], ids[order], scores[ids[order]], chars[order])


    @staticmethod
    def _word_pattern(pairs: set[str]) -> re.Pattern | None:
        """Space marks and a run of characters that pieces can join; ``pairs``: neighbours inside pieces."""
        if any(a != SPACE and b == SPACE for a, b in pairs):
            return None
        root: dict[str, str] = {}

        def find(c: str) -> str:
            while root.setdefault(c, c) != c:
                c = root[c]
            return c

        for a, b in pairs:
            if SPACE not in (a, b):
                root[find(a)] = find(b)
        groups: dict[str, list[str]] = {}
        for c in list(root):
            groups.setdefault(find(c), []).append(c)
        classes = ["[" + "".join(map(re.escape, sorted(g))) + "]+" for g in sorted(groups.values(), key=len, reverse=True)]
        alone = "[^" + re.escape(SPACE) + "".join(map(re.escape, sorted(root))) + "]+"
        return re.compile(f"{SPACE}*(?:{'|'.join([*classes, alone])})|{SPACE}+")


def _extend(h: np.ndarray, column: np.ndarray) -> np.ndarray:
    """64-bit hashes of substrings that grow by one code point each."""
    h = (h ^ column.astype(np.uint64)) * _BASE
    return h ^ (h >> np.uint64(29))


def hash_rows(chars: np.ndarray) -> np.ndarray:
    h = np.zeros(len(chars), dtype=np.uint64)
    for column in chars.T:
        h = _extend(h, column)
    return h


def segment(model: Model, chars: np.ndarray) -> tuple[np.ndarray, int]:
    """Ids of equal-length words (rows of code points), right-aligned, and the filler of unused places;
    -1 - k marks character k without a piece.

    All words step through the start positions together.  Earlier starts come first, so an
    equal sum never replaces a longer last piece.
    """
    n, length = chars.shape
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0.0
    back = np.zeros((length + 1, n), dtype=np.int32)
    piece = np.full((length + 1, n), -1, dtype=np.int64)
    longest = max(model.tables, default=0)
    for start in range(length):
        h = np.zeros(n, dtype=np.uint64)
        bare = np.ones(n, dtype=bool)
        for size in range(1, min(longest, length - start) + 1):
            h = _extend(h, chars[:, start + size - 1])
            if size not in model.tables:
                continue
            keys, ids, scores, texts = model.tables[size]
            at = np.searchsorted(keys, h)
            at[at == len(keys)] = 0
            hit = np.flatnonzero(keys[at] == h)
            if not len(hit):
                continue
            hit = hit[(texts[at[hit]] == chars[hit, start:start + size]).all(axis=1)]
            if size == 1:
                bare[hit] = False
            total = best[start, hit] + scores[at[hit]]
            better = total > best[start + size, hit]
            rows, end = hit[better], start + size
            best[end, rows], back[end, rows], piece[end, rows] = total[better], size, ids[at[rows]]
        total = best[start] + model.unknown_score
        rows, end = np.flatnonzero(bare & (total > best[start + 1])), start + 1
        best[end, rows], back[end, rows], piece[end, rows] = total[rows], 1, -1 - start
    # walk all words back together
    none = np.iinfo(np.int64).min
    out = np.full((n, length), none)
    at = np.full(n, length)
    for slot in range(length - 1, -1, -1):
        live = np.flatnonzero(at > 0)
        if not len(live):
            break
        out[live, slot] = piece[at[live], live]
        at[live] -= back[at[live], live]
    return out, none


class Encoder:
    """Ids of texts; the ids of distinct words are cached (bounded)."""

    #: a space mark of the text itself trades places with the space: no piece holds a space, so it becomes byte pieces
    SWAP = {ord(" "): SPACE, ord(SPACE): " "}

    def __init__(self, path: str):
        self.model = Model(path)
        self.cache: dict[str, bytes] = {}

    def _words(self, text: str) -> list[str]:
        s = SPACE + (text.translate(self.SWAP) if SPACE in text else text.replace(" ", SPACE))
        return self.model.word.findall(s) if self.model.word else [s]

    def _search(self, words: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, group in by_length.items():
            block = max(1, min(_BLOCK, 2_000_000 // length))
            for i in range(0, len(group), block):
                some = group[i:i + block]
                chars = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(some), length)
                ids, none = segment(self.model, chars)
                used = ids != none
                marked = (used & (ids < 0)).any(axis=1)
                flat = ids[used].astype("<i4").tobytes()
                ends = (4 * np.cumsum(used.sum(axis=1))).tolist()
                self.cache.update(zip(some, [flat[a:b] for a, b in zip([0, *ends], ends)]))
                for k in np.flatnonzero(marked).tolist():
                    self.cache[some[k]] = self._with_bytes(some[k], ids[k][used[k]]).astype("<i4").tobytes()

    def _with_bytes(self, word: str, ids: np.ndarray) -> np.ndarray:
        """Marks of uncovered characters replaced by the byte pieces of the character."""
        out: list[int] = []
        for x in ids.tolist():
            if x >= 0:
                out.append(x)
            elif self.model.has_bytes:
                c = word[-x - 1]
                out += [int(self.model.byte_ids[b]) for b in (SPACE if c == " " else c).encode("utf-8", "surrogatepass")]
            else:
                out.append(self.model.unknown)
        return np.array(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) > _CACHE:
            self.cache.clear()
        cache = self.cache
        split = [self._words(t) if t else [] for t in texts]
        new = {w for ws in split for w in ws if w not in cache}
        if new:
            self._search(list(new))
        return [np.frombuffer(b"".join([cache[w] for w in ws]), dtype="<i4") for ws in split]

    def decode(self, ids) -> str:
        """Text of a sequence of ids: the pieces' bytes in a row, the leading space dropped."""
        table = self.model.bytes_of
        text = b"".join([table[i] for i in np.asarray(ids).tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, ids array<int>) for every row of ``docs``, repeated rows and null ids included.

    Null and empty texts have no ids.  Texts are encoded whole, word by word, in batches of
    equal length; one very long word is one row of its batch.  Ties between sums go to the
    longer last piece.  Other columns, whatever their names, are not read.  Empty table: empty result.
    """
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_file)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = encoder.encode([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(doc), pa.array(ids, pa.list_(pa.int32()))], [doc, "ids"])

    return docs.select(doc, text).mapInArrow(run, f"{doc} {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, model_file: str, doc: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc, text) of id sequences, one row per row; a null sequence decodes to a null text, an empty one to an
    empty text.  Other columns are not read.  Empty table: empty result."""
    kind = encoded.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_file)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(doc), pa.array(texts, pa.string())], [doc, "text"])

    return encoded.select(doc, ids).mapInArrow(run, f"{doc} {kind}, text string")


def round_trip(docs: DataFrame, model_file: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, n_ids, ids_crc32, n_byte_ids, text_crc32 of the decoded text, exact): encode and decode every row, with
    the cases of ``encode_documents`` (a null text counts as empty)."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_file)
        bytes_of = encoder.model.byte_of
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [t or "" for t in part.column(text).to_pylist()]
                ids = encoder.encode(texts)
                back = [encoder.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(doc), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                     pa.array([int((bytes_of[x] >= 0).sum()) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in back], pa.int64()),
                     pa.array([a == b for a, b in zip(texts, back)], pa.bool_())],
                    [doc, "n_ids", "ids_crc32", "n_byte_ids", "decoded_crc32", "exact"])

    return docs.select(doc, text).mapInArrow(
        run, f"{doc} {kind}, n_ids long, ids_crc32 long, n_byte_ids long, decoded_crc32 long, exact boolean")
