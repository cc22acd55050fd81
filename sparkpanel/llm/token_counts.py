"""Token counts of whole texts by the whole-token shortcut.

A BPE model cuts a text into pre-tokens and merges inside each of them.  Which vocabulary
strings come out of their own merges as exactly one token is a property of the file alone,
so it is proven once, before any text is read (``whole_tokens``): each vocabulary string is
given to the model by itself and must return itself.  In the texts a pre-token among the
proven strings counts one without any merging; only the rest is merged by the model, once
per distinct pre-token of a task (a bounded memo).

The proven strings are broadcast: never more than the vocabulary file has.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: texts handed to Python at once; distinct merged pre-tokens remembered per task; longest one remembered
ROWS, MEMO, MEMO_CHARS = 500, 200_000, 64
#: fixed value: the split pattern of the word-level file, and the same classes over the plain alphabet,
#: where every library agrees on what is a letter, a digit and a blank
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ {_LETTERS}0-9]+")
_PLAIN = re.compile("[ -~À-ɏ]*")


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
        raise ValueError(f"{path}: only deterministic BPE files are supported")
    for t in spec.get("added_tokens", []):
        if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]:
            raise ValueError(f"{path}: added token {t['content']!r} is matched by rules that are not supported")
    return spec


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, all others for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


def whole_tokens(path: str) -> frozenset[str]:
    """The pre-tokens (byte-level letters) that the model of the file at ``path`` returns as one token."""
    from tokenizers import Tokenizer

    spec = _spec(path)["model"]
    suffix = spec.get("end_of_word_suffix") or ""
    model = Tokenizer.from_file(path).model
    proven = set()
    for token, number in spec["vocab"].items():
        if not token.endswith(suffix) or token == suffix:
            continue
        word = token[:len(token) - len(suffix)]
        found = model.tokenize(word)
        if len(found) == 1 and found[0].id == number:
            proven.add(word)
    return frozenset(proven)


class _Costs(dict):
    """Tokens per pre-token: one for the proven strings, all others by merging (remembered, bounded)."""

    def __init__(self, whole: dict[str, int], merge: Callable[[str], int]):
        super().__init__(whole)
        self.base, self.merge = len(whole), merge

    def __missing__(self, word: str) -> int:
        n = self.merge(word)
        if len(word) <= MEMO_CHARS and len(self) < self.base + MEMO:
            self[word] = n
        return n


class TokenCounter:
    """Counts the tokens of texts like the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        from tokenizers import Tokenizer

        spec, tokenizer = _spec(path), Tokenizer.from_file(path)
        whole = whole_tokens(path) if whole is None else whole
        self.normalise = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str if tokenizer.pre_tokenizer else lambda t: [(t, None)] if t else []
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        letters = _byte_letters()
        to_letters = {b: ord(c) for b, c in letters.items()}
        model = tokenizer.model
        self.costs = _Costs(dict.fromkeys(whole, 1), lambda w: len(model.tokenize(w)))
        pre = json.dumps(spec.get("pre_tokenizer"))
        self.plain = None
        if json.dumps(_WORD_PATTERN)[1:-1] in pre and '"ByteLevel"' in pre:
            back = {ord(c): b for b, c in letters.items()}
            readable = {}
            for w in whole:
                try:
                    readable[w.translate(back).encode("latin-1").decode("utf-8")] = 1
                except UnicodeError:
                    continue  # part of a character: never a pre-token of plain text
            self.plain = _Costs(readable, lambda w: len(model.tokenize(w.encode("utf-8").decode("latin-1").translate(to_letters))))

    def _part(self, text: str) -> int:
        text = self.normalise(text)
        if self.plain is not None and _PLAIN.fullmatch(text):
            return sum(map(self.plain.__getitem__, _PLAIN_SPLIT.findall(text)))
        return sum(self.costs[w] for w, _ in self.split(text))

    def count(self, text: str) -> int:
        """Added tokens inside the text count one each; the parts between them are counted apart."""
        if self.special is None:
            return self._part(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._part(p) for p in parts if p)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    Whole texts are counted, whatever their length; no begin, end or padding tokens.  Special
    strings inside a text are tokens, as the library reads them by default.  Null and empty
    texts: 0 bytes, 0 tokens.  Null ids, repeated rows and ties stay as they are, a row each.
    Other columns, whatever their names, are not read.  Empty table: empty result.
    """
    handle = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or TokenCounter(tokenizer, handle.value)
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                counts = [counter.count(t) if t else 0 for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64())],
                                                 ["doc", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text).alias("text"))
    kind = docs.schema[doc].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, n_bytes long, n_tokens long").select(
        F.col("doc").alias(doc), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
