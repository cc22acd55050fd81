"""Language identification: word-first backoff.

Model: log frequency per language of known words, and of character n-grams of length
``MAX_N`` down to 1 for words that are not known.  A text's score for a language is the
sum over its words; a word that the model knows is looked up, any other word falls back
to its longest n-grams of which at least one is known (their mean log frequency).

Nothing counted is left out: every (language, token) count of ALL training rows is kept in
one written table.  A log frequency is the language's value for an absent token, which is
the same for all tokens of a length, plus ``log(2 n + 1)`` for a token counted ``n`` times,
so a token's row names only the languages that have it.  The ``HOT_WORDS`` most frequent
words are summed up inside the tasks that cut the texts; the other words are looked up by
joins, each distinct unknown word falls back to n-grams once, and both kinds add up alike.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import join_weighted, materialise

MAX_N = 4
#: letters of a word whose n-grams are cut at once
PIECE = 256
#: words that travel to the tasks with their counts, and how many numbers these may be (fewer words for
#: very many languages); both decide where a word is added up, not whether
HOT_WORDS = 150_000
HOT_NUMBERS = 2_000_000
#: a text is clear when its language has this part of the share of words that it has of the middle training text
CLEAR_PART = 0.5
#: stands for "no level" where a word has no known n-gram: such a word adds nothing
NOWHERE = MAX_N + 1
UNKNOWN = "und"
#: letters-digits runs without decimal digits and underscores; refined by isalpha() per distinct word
_RUN = re.compile(r"[^\W\d_]+")
#: letters of the texts that are cut at once (one longer text is cut by itself)
_CHUNK = 1 << 20
_FLUSH = 200_000


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters (Unicode L*): what ``_cut_texts`` cuts, text by text."""
    out = _RUN.findall(text.lower())
    if not out or "".join(out).isalpha():
        return out
    return [p for w in out for p in "".join(c if c.isalpha() else " " for c in w).split()]


def _name(word: Column) -> Column:
    """The word as a key: itself, or a digest that no word equals when it is long."""
    return F.when(F.length(word) <= 32, word).otherwise(F.concat(F.lit("\x01"), F.md5(word.cast("binary"))))


def _tokens(words: DataFrame, levels) -> DataFrame:
    """One row per token of the column ``word``, as ``key``: the level's digit and the token.  Level 0 is
    the whole word, level n its n-grams between boundary marks (single letters without marks)."""
    # a long word is cut first, so no row that is made per letter carries it; explode of a sequence runs as generated
    # code at every step, a lambda would not
    cut = words.withColumn("__s", F.concat(F.lit("\x02"), "word", F.lit("\x03"))).withColumn("__n", F.length("__s")) \
        .withColumn("__w", _name(F.col("word"))).drop("word").withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(PIECE)))) \
        .withColumn("__t", F.substr("__s", F.col("__o") + 1, F.lit(PIECE + MAX_N - 1))).drop("__s")
    at = cut.withColumn("__i", F.explode(F.sequence(F.lit(1), F.least(F.lit(PIECE), F.col("__n") - F.col("__o")))))
    place = F.col("__o") + F.col("__i")
    left = F.col("__n") - place  # letters and marks after this one

    def key(n: int) -> Column:
        if n == 0:
            return F.when(place == 1, F.concat(F.lit("0"), F.col("__w")))
        there = (place > 1) & (left > 0) if n == 1 else left >= n - 1
        return F.when(there, F.concat(F.lit(str(n)), F.substr("__t", "__i", F.lit(n))))

    return at.withColumn("key", F.explode(F.array(*[key(n) for n in levels]))).where("key is not null").drop("__t", "__o", "__i", "__n", "__w")


@functools.cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _chunks(texts: list[str]):
    """Slices of the list, each of about ``_CHUNK`` letters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _CHUNK:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _cut_texts(texts: list[str]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The distinct words of the texts, and for every word in all texts, in their order, its place among
    the distinct ones and the number of its text."""
    low = [text.lower() + "\n" for text in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)
    letter = _letters().take(points)
    edges = np.flatnonzero(letter[1:] != letter[:-1]) + 1  # the last code point is no letter
    if letter[0]:
        edges = np.concatenate(([0], edges))
    starts, stops = edges[::2], edges[1::2]
    ends = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))
    text = np.repeat(np.arange(len(low)), np.diff(np.searchsorted(starts, ends), prepend=0))
    body = points[letter]
    data = body.tobytes().decode("utf-32-le").encode()
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=offsets[1:])
    if len(data) > len(body):  # some letters have more than one byte
        more = np.zeros(len(body) + 1, np.int64)
        np.cumsum(sum((body > most).view(np.uint8) for most in (0x7F, 0x7FF, 0xFFFF)), out=more[1:])
        offsets += more[offsets]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    return words.dictionary.cast(pa.string()), words.indices.to_numpy().astype(np.int64), text


def _count_words(batches):
    def added_up(tables):
        return pa.concat_tables(tables).group_by(["lang", "word"]).aggregate([("n", "sum")]).select(["lang", "word", "n_sum"]).rename_columns(["lang", "word", "n"])

    tables, rows = [], 0
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for part in _chunks(texts):
            names = sorted(set(langs[part]))
            number = {lang: j for j, lang in enumerate(names)}
            words, word, text = _cut_texts(texts[part])
            of = np.array([number[lang] for lang in langs[part]])[text]
            pairs, n = np.unique(of * len(words) + word, return_counts=True)
            which, word = np.divmod(pairs, max(1, len(words)))
            tables.append(pa.table({"lang": pa.array(names, pa.string()).take(pa.array(which)), "word": words.take(pa.array(word)), "n": n}))
            rows += len(pairs)
            if rows > 2 * _FLUSH:
                tables = [added_up(tables)]
                rows = tables[0].num_rows
                if rows > _FLUSH:
                    yield from tables[0].to_batches()
                    tables, rows = [], 0
    if tables:
        yield from added_up(tables).to_batches()


def train(train_docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Count words and n-grams per language over all rows with text and language.

    Returns the sorted languages, the written table of all tokens (``key``, ``hits`` with one
    count per language that has the token, ``total``) and per level and language the log
    frequency of an absent token.
    """
    rows = train_docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    table = materialise(rows.mapInArrow(_count_words, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langwords")
    langs = sorted(r["lang"] for r in table.select("lang").distinct().collect())
    model: dict = {"langs": langs}
    if not langs:
        return model
    numbers = train_docs.sparkSession.createDataFrame([(lg, j) for j, lg in enumerate(langs)], "lang string, l int")
    tokens = _tokens(table.join(F.broadcast(numbers), "lang").select("l", "word", "n"), range(NOWHERE))
    model["tokens"] = materialise(tokens.groupBy("key", "l").agg(F.sum("n").alias("n")).groupBy("key")
                                  .agg(F.collect_list(F.struct("l", "n")).alias("hits"), F.sum("n").alias("total")), "langtokens")
    level = F.left("key", F.lit(1)).cast("int").alias("level")
    sums = model["tokens"].select(level, F.inline("hits")).groupBy("level", "l").agg(F.sum("n").alias("n")).collect()
    sizes = {r["level"]: r["count"] for r in model["tokens"].groupBy(level).count().collect()}
    totals = np.zeros((NOWHERE, len(langs)))
    for r in sums:
        totals[r["level"], r["l"]] = r["n"]
    size = np.array([[sizes.get(n, 0)] for n in range(NOWHERE)])
    model["absent"] = np.vstack([np.log(0.5 / (totals + 0.5 * (size + 1))), np.zeros(len(langs))])
    return model


def _hot_words(model: dict) -> tuple[dict[str, int], np.ndarray]:
    """Rows of the most frequent words, and per row the gain of each language over an absent word."""
    n_words = max(1, min(HOT_WORDS, HOT_NUMBERS // len(model["langs"])))
    top = model["tokens"].where(F.col("key").startswith("0") & ~F.col("key").startswith("0\x01")) \
        .orderBy(F.desc("total"), "key").limit(n_words).select(F.substring("key", 2, 32).alias("word"), "hits.l", "hits.n").toArrow().combine_chunks()
    ls, ns = top["l"].combine_chunks(), top["n"].combine_chunks()
    gain = np.zeros((len(top), len(model["langs"])))
    gain[np.repeat(np.arange(len(top)), ls.value_lengths().to_numpy()), ls.flatten().to_numpy()] = np.log1p(2.0 * ns.flatten().to_numpy())
    return {w: i for i, w in enumerate(top["word"].to_pylist())}, gain


def _cut_words(docs: DataFrame, model: dict, clear: bool) -> DataFrame:
    """Per row of ``docs`` (rid, key, text, trained): ``own``, the number of the language it was trained
    with or -1; ``sums`` with the number of all words, the hot words' gain per language and (with ``clear``, else
    zeros) how many of them the language knows from other texts (empty for no words at all); the other words with their counts."""
    handle = docs.sparkSession.sparkContext.broadcast(_hot_words(model))
    numbers = {lg: j for j, lg in enumerate(model["langs"])}

    def run(batches):
        index, gain = handle.value
        n_hot, gain = len(gain), np.ascontiguousarray(gain.T)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            owns = np.array([numbers.get(lang, -1) for lang in batch.column("trained").to_pylist()])
            for part in _chunks(texts):
                size, own = part.stop - part.start, owns[part]
                words, word, text = _cut_texts(texts[part])
                # per text and distinct word one number: hot words by their row, the others after them
                slots = n_hot + len(words)
                slot = np.array([index.get(w, n_hot + i) for i, w in enumerate(words.to_pylist())], np.int64)
                pairs, n = np.unique(text * slots + slot[word], return_counts=True)
                text, slot = np.divmod(pairs, max(1, slots))
                hot = slot < n_hot
                at, of, weight = slot[hot], text[hot], n[hot].astype(float)
                sums = np.zeros((size, 1 + 2 * len(numbers)))
                sums[:, 0] = np.bincount(text, n, size)
                alone = np.log1p(2 * weight) + 1e-9
                for j in range(len(numbers)):
                    gains = gain[j].take(at)
                    sums[:, 1 + j] = np.bincount(of, weight * gains, size)
                    if clear:
                        known = gains > np.where(own[of] == j, alone, 0)
                        sums[:, 1 + len(numbers) + j] = np.bincount(of, weight * known, size)
                some = sums[:, 0] > 0
                at, of = slot[~hot] - n_hot, text[~hot]
                rare = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=size)))).astype(np.int32)
                lists = {"sums": (np.concatenate(([0], np.cumsum(some * sums.shape[1]))).astype(np.int32), sums[some].ravel()),
                         "words": (rare, words.take(pa.array(at))), "ns": (rare, n[~hot])}
                rows = batch.slice(part.start, size)
                yield pa.RecordBatch.from_pydict({"rid": rows.column("rid"), "key": rows.column("key"), "own": own.astype(np.int32),
                                                  **{c: pa.ListArray.from_arrays(pa.array(o), pa.array(v)) for c, (o, v) in lists.items()}})

    return docs.mapInArrow(run, "rid long, key string, own int, sums array<double>, words array<string>, ns array<long>")


_GAINS = "transform(hits, h -> struct(h.l as l, log1p(2D * h.n) as v))"


def _back_off(unknown: DataFrame, tokens: DataFrame, levels) -> DataFrame:
    """Unknown words (name, word, uses) that have known n-grams at one of ``levels``: the longest
    such level and per language the mean gain of the known n-grams."""
    grams = materialise(_tokens(unknown.select("name", "word"), levels), "langgrams")
    needed = materialise(grams.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).join(tokens, "key").select("key", "rows", "hits"), "langneeded")
    hits = join_weighted(grams, needed, "key", "rows", grams.count())
    found = hits.select("name", F.left("key", F.lit(1)).cast("int").alias("level"),
                        F.inline(F.expr(f"array_append({_GAINS}, struct(-1 as l, 1D as v))")))
    found = found.groupBy("name", "level", "l").agg(F.sum("v").alias("v")).groupBy("name", "level") \
        .agg(F.collect_list(F.struct("l", "v")).alias("e"), F.max(F.when(F.col("l") == -1, F.col("v"))).alias("k"))
    best = found.groupBy("name").agg(F.max("level").alias("level"), F.max_by(F.struct("e", "k"), "level").alias("b"))
    gains = F.expr("transform(filter(b.e, x -> x.l >= 0), x -> struct(x.l as l, x.v / b.k as v))").alias("gains")
    return materialise(best.join(unknown.select("name", "uses"), "name").select("name", "uses", "level", gains), "langbackoff")


def _rare_sums(cut: DataFrame, model: dict) -> DataFrame:
    """Per rid the gains ``v`` of its rare words by language ``l`` and the number ``k`` of them that the
    language knows from other texts; the number of its words that only
    level n > 0 or no level has stands at ``l`` = -n."""
    rare = cut.select("rid", "own", F.inline(F.arrays_zip("words", "ns")))
    vocabulary = rare.groupBy("words").agg(F.count(F.lit(1)).alias("uses")).select(_name(F.col("words")).alias("name"), F.col("words").alias("word"), "uses")
    tokens = model["tokens"]
    whole = tokens.where(F.col("key").startswith("0")).select(F.substring("key", 2, 1 << 30).alias("name"), "hits")
    seen = materialise(vocabulary.join(whole, "name", "left"), "langseen")
    found = seen.where("hits is not null").select("name", "uses", F.lit(0).alias("level"), F.expr(_GAINS).alias("gains"))
    unknown = seen.where("hits is null").select("name", "word", "uses")
    for levels in ([MAX_N], range(MAX_N - 1, 0, -1)):  # nearly all words end at the first step
        if unknown.isEmpty():
            break
        step = _back_off(unknown, tokens, levels)
        found = found.unionByName(step)
        unknown = unknown.join(step.select("name"), "name", "left_anti")
    found = found.unionByName(unknown.select("name", "uses", F.lit(NOWHERE).alias("level"), F.expr("filter(array(struct(0 as l, 0D as v)), x -> false)").alias("gains")))
    n_rows = seen.agg(F.sum("uses")).first()[0] or 0
    used = join_weighted(rare.select("rid", "own", _name(F.col("words")).alias("name"), F.col("ns").alias("n")), found, "name", "uses", n_rows)
    each = used.select("rid", F.inline(F.expr(
        "concat(transform(gains, g -> struct(g.l as l, n * g.v as v, "
        "if(level = 0 and (g.l <> own or g.v > log1p(2D * n) + 1e-9D), double(n), 0D) as k)), "
        "filter(array(struct(-level as l, double(n) as v, 0D as k)), x -> x.l < 0))")))
    return each.groupBy("rid", "l").agg(F.sum("v").alias("v"), F.sum("k").alias("k")).groupBy("rid").agg(F.collect_list(F.struct("l", "v", "k")).alias("s"))


def predict(docs: DataFrame, model: dict, text: str = "text", trained: Column | None = None) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (the chosen language's share of the
    likelihood, 0 to 1).  ``und`` with score 0 for a null text, a text without letters,
    or a model without languages; a text none of whose n-grams is known gets the first
    language and score 1 / number of languages.  All other columns pass through, whatever
    their names.  Texts are read whole, whatever their length; repeated rows get the same
    result each; ties go to the first language in sorted order.  Empty table: empty result.

    With ``trained`` (the language a row was trained with, null for other rows) also ``lang_known``, the
    share of the text's words that the chosen language knows from other texts, and ``lang_clear``: that
    share is above 0 and at least CLEAR_PART of its median over the language's training texts.  The score
    goes to 1 with the length of any text, this share does not depend on the length.  A word of a training
    text is known from others when the language counts it more often than the text does (copies of
    the text are others).
    """
    added = ["lang_pred", "score"] + ["lang_known", "lang_clear"] * (trained is not None)
    columns = [c for c in docs.columns if c not in added]
    if not model["langs"]:
        none = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "lang_known": F.lit(0.0), "lang_clear": F.lit(False)}
        return docs.select(*columns, *[none[c].alias(c) for c in added])
    own = F.lit(None).cast("string") if trained is None else trained
    key = F.concat_ws("|", F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("")), own)
    cut = materialise(_cut_words(docs.select(F.monotonically_increasing_id().alias("rid"), key.alias("key"), F.col(text).alias("text"),
                                             own.alias("trained")), model, trained is not None), "langcut")
    absent = model["absent"]

    @F.pandas_udf("best int, score double, known double")
    def choose(sums: pd.Series, ls: pd.Series, vs: pd.Series, ks: pd.Series) -> pd.DataFrame:
        out = []
        for hot, at, more, known in zip(sums, ls, vs, ks):
            if not len(hot):
                out.append((-1, 0.0, 0.0))
                continue
            found = np.zeros(len(absent))
            total, words = np.array(hot[1:]).reshape(2, -1)
            if at is not None:
                at, more = np.asarray(at), np.asarray(more)
                total[at[at >= 0]] += more[at >= 0]
                words[at[at >= 0]] += np.asarray(known)[at >= 0]
                found[-at[at < 0]] = more[at < 0]
            found[0] = hot[0] - found.sum()
            total = total + found @ absent
            e = np.exp(total - total.max())
            best = int(e.argmax())  # ties: the first language in sorted order
            out.append((best, float(e[best] / e.sum()), float(words[best] / hot[0])))
        return pd.DataFrame(out, columns=["best", "score", "known"])

    scored = cut.select("rid", "key", "own", "sums").join(_rare_sums(cut, model), "rid", "left") \
        .select("rid", "key", "own", choose("sums", "s.l", "s.v", "s.k").alias("p"))
    # equal texts have one result; the smallest rid stands for them
    per_text = materialise(scored.groupBy("key").agg(F.min(F.struct("rid", "own", "p.*")).alias("p"), F.count(F.lit(1)).alias("copies"))
                           .select("key", "copies", "p.own", "p.best", "p.score", "p.known"), "langscores")
    n_rows = per_text.agg(F.sum("copies")).first()[0] or 0
    if trained is not None:
        # the middle share in steps of a thousandth, from counts: the same in every run
        steps = per_text.where("best = own").groupBy("best", F.floor(F.col("known") * 1000).alias("step")).agg(F.count(F.lit(1)).alias("c"))
        of = Window.partitionBy("best")
        steps = steps.withColumn("upto", F.sum("c").over(of.orderBy("step"))).withColumn("n", F.sum("c").over(of))
        middle = steps.where(2 * F.col("upto") >= F.col("n")).groupBy("best").agg((F.min("step") / 1000).alias("middle"))
        per_text = per_text.join(F.broadcast(middle), "best", "left") \
            .withColumn("clear", (F.col("known") > 0) & (F.col("known") >= CLEAR_PART * F.coalesce("middle", F.lit(0.0))))
    # the row travels as one struct, so its column names cannot clash with the helper's
    rows = docs.select(key.alias("key"), F.struct(*[F.col(c) for c in columns]).alias("row"))
    names = F.from_json(F.lit(json.dumps(model["langs"])), "array<string>")
    values = {"lang_pred": F.coalesce(F.get(names, F.col("best")), F.lit(UNKNOWN)), "score": F.col("score"),
              "lang_known": F.col("known"), "lang_clear": F.col("clear")}
    return join_weighted(rows, per_text, "key", "copies", n_rows) \
        .select(*[F.col("row").getField(c).alias(c) for c in columns], *[values[c].alias(c) for c in added])


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, clear: bool = False) -> DataFrame:
    """Train on the rows that are not held out (null ids are not trained on either) and
    label every row of ``docs``; ``clear`` adds ``lang_known`` and ``lang_clear``."""
    model = train(docs.where(~held_out()))
    return predict(docs, model, trained=F.when(~held_out() & F.col("text").isNotNull(), F.col("lang")) if clear else None)
