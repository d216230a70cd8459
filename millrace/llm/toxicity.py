"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks.

A word is known by its letter triples, in order but with gaps: a triple that spans ``n`` letters weighs
``DECAY ** n`` up to a span of ``SPAN``. So ``id-iot``, ``iidiot`` and ``i d i o t`` stay close to the insult
they hide. Words and landmarks are compared by that kernel; a support vector machine is fitted on the
landmarks' coordinates. Since the kernel is a product over explicit triples (64 symbols, 262,144 of them), the fitted machine is one
table of triple weights, and scoring a text is a sum per word and a maximum over its words: time and memory
grow with the text, not with the landmarks.

Labels belong to texts, insults are words in them: each toxic text of the sample is represented by its most
telling words (log odds among the sample's texts within 1 of its largest), clean ones by words of all kinds and then by those
that the first fit gets most wrong.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.session import materialize

DECAY = 0.6
SPAN = 6
_STEPS = tuple(combinations(range(1, SPAN), 2))
_SYMBOLS = 64
_START, _OTHER, _ACCENTED, _BLANK = 27, 28, 29, 63
_TABLE_SIZE = 0x250
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


def _symbol_table() -> np.ndarray:
    """Symbols of the first letters of Unicode, by lower case: a-z and what looks like them, Latin-1's others."""
    out = np.zeros(_TABLE_SIZE + 1, np.uint8)
    for i in range(_TABLE_SIZE):
        c = chr(i)
        c = _LOOKALIKE.get(c, c.lower()[:1])
        if c.isspace():
            out[i] = _BLANK
        elif "a" <= c <= "z":
            out[i] = ord(c) - 96
        elif "ß" <= c <= "ÿ" and c.isalpha():
            out[i] = _ACCENTED + ord(c) - ord("ß")
        elif c.isalpha():
            out[i] = _OTHER
    out[_TABLE_SIZE] = _OTHER
    return out


def _spelt(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words, each after a start mark; where words begin; and each text's first word.

    Marks and punctuation inside a word are gaps. Single letters in a row are one word.
    """
    joined = b"".join(b" " + t for t in texts).decode()
    symbols = flat.per_process("symbols", _symbol_table)[np.minimum(np.frombuffer(joined.encode("utf-32-le"), np.uint32), _TABLE_SIZE)]
    sizes = np.array([len(t.decode()) + 1 for t in texts])
    blank = symbols == _BLANK
    start = blank.copy()
    start[:-1] &= ~blank[1:]
    start[-1:] = False
    symbols[start] = _START
    kept = ~blank | start
    texts_at = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], np.cumsum(sizes)))]
    symbols = symbols[kept]
    words = np.flatnonzero(symbols == _START)
    single = np.diff(np.append(words, len(symbols))) == 2
    joins = single.copy()
    joins[1:] &= single[:-1]
    joins[:1] = False
    joins &= ~np.isin(words, texts_at)
    stays = np.ones(len(symbols), bool)
    stays[words[joins]] = False
    place = np.concatenate(([0], np.cumsum(stays)))
    words = place[words[~joins]]
    return symbols[stays], words, np.searchsorted(words, place[texts_at])


def _triples(symbols: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of steps: the first letters that have both within their word, the triple, its weight."""
    n = len(symbols)
    room = np.repeat(np.append(words[1:], n), np.diff(np.append(words, n))) - np.arange(n)
    codes = symbols.astype(np.int32)
    for a, b in _STEPS:
        if n > b:
            yield room[: n - b] > b, (codes[: n - b] << 12) | (codes[a : n - b + a] << 6) | codes[b:], DECAY ** (b + 1)


def _scale(lengths: np.ndarray) -> np.ndarray:
    """Norm of a word of so many symbols, none of them twice: the kernel is divided by it on both sides."""
    square = sum(np.maximum(lengths - b, 0) * DECAY ** (2 * b + 2) for _, b in _STEPS)
    return np.sqrt(np.maximum(square, DECAY**6))


def word_margins(table: np.ndarray, bias: float, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The machine's margin of every word, and each text's first word."""
    symbols, words, firsts = _spelt(texts)
    if not len(words):
        return np.zeros(0), firsts
    total = np.zeros(len(symbols), np.float32)
    for fits, triple, weight in _triples(symbols, words):
        total[: len(fits)] += np.where(fits, table[triple], np.float32(0)) * np.float32(weight)
    lengths = np.diff(np.append(words, len(symbols)))
    return np.add.reduceat(total, words).astype(np.float64) / _scale(lengths) + bias, firsts


def _features(texts: list[str], columns: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Triple weights of single words, one row each, and the triples (``columns``, or all that occur)."""
    symbols, words, firsts = _spelt([t.encode() for t in texts])
    own = np.repeat(np.searchsorted(firsts, np.arange(len(words)), "right") - 1, np.diff(np.append(words, len(symbols))))
    parts = [(own[np.flatnonzero(fits)], triple[fits], np.full(fits.sum(), weight)) for fits, triple, weight in _triples(symbols, words)]
    row, triple, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    whole = (triple >> 12 > 0) & (triple >> 6 & 63 > 0) & (triple & 63 > 0)
    row, triple, weight = row[whole], triple[whole], weight[whole]
    if columns is None:
        columns = np.unique(triple)
    place = np.minimum(np.searchsorted(columns, triple), len(columns) - 1)
    known = columns[place] == triple
    out = np.zeros((len(texts), len(columns)))
    np.add.at(out, (row[known], place[known]), weight[known])
    return out / _scale(np.bincount(own, minlength=len(texts)))[:, None], columns


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        a = x[inside] * (cost * weight[inside])[:, None]
        new = np.linalg.solve(np.eye(len(w)) + a.T @ x[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Triple weights and bias of the machine; log odds by a text's largest and second margin, and 1."""

    table: np.ndarray
    bias: float
    line: tuple[float, float, float] | None


#: The range of margins that counts; what is missing has the least.
_LEAST, _MOST = -1.0, 1.0


def text_margins(table: np.ndarray, bias: float, texts: list[bytes]) -> np.ndarray:
    """The largest and the second margin among each text's words."""
    found, firsts = word_margins(table, bias, texts)
    best = np.full((len(texts), 2), _LEAST)
    some = np.flatnonzero(np.diff(firsts))
    if len(some):
        found = np.clip(found, _LEAST, _MOST)
        best[some, 0] = np.maximum.reduceat(found, firsts[some])
        own = np.repeat(np.arange(len(texts)), np.diff(firsts))
        at = np.flatnonzero(found == best[own, 0])
        found[at[np.concatenate(([True], own[at][1:] != own[at][:-1]))]] = _LEAST
        best[some, 1] = np.maximum.reduceat(found, firsts[some])
    return best


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(text: Column) -> Column:
    bare = F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.array_distinct(F.filter(bare, lambda w: F.length(w).between(2, 40)))


def fit(docs: DataFrame, labels: DataFrame, toxic_texts: int = 3000, clean_texts: int = 6000, landmarks: int = 300, toxic_words: int = 1500, usual_words: int = 2000, other_words: int = 4000, hard_words: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a sample of labelled rows of ``docs``: at most ``toxic_texts`` and ``clean_texts`` of them.

    The bounds are those of the sample alone, which the driver picks by hash of the id; rows of ``labels``
    with a null label, and those whose ``crc32(id) % 3`` is 1, are never learnt from. Several labels of one id
    count as toxic if one is. Only ids, labels and texts are used. Without both classes there is nothing to
    learn, nor is there when no word stands in three toxic texts or more and seldom in clean ones: every score
    is then 0.

    The machine is fitted on words of the sample, of 2 to 40 letters. These bounds are of its training set
    alone, all texts are scored whole: ``toxic_words`` that tell most toxic texts, the ``usual_words`` most
    found in clean ones, ``other_words`` of the clean ones picked by hash, and twice the ``hard_words`` that it
    then gets most wrong.
    """
    flat.small_batches(docs)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("id")
    picked = known.where("toxic = 1").orderBy(order).limit(toxic_texts).unionByName(known.where("toxic = 0").orderBy(order).limit(clean_texts))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    # Broadcast: the sample has at most toxic_texts + clean_texts ids. An id of several rows gives one text.
    sample = own.join(F.broadcast(picked), "id").groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    sample = materialize(sample.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("id").alias("id")), "sample")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(np.zeros(_SYMBOLS**3, np.float32), _LEAST, None)

    spelled = materialize(sample.select("id", "toxic", F.explode(_words(F.col("text"))).alias("word")), "sample-words")
    odds = F.log((F.sum("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.count("*") - F.sum("toxic") + 0.5) / (sizes[0] + 1))
    counted = materialize(spelled.groupBy("word").agg(odds.alias("odds"), F.sum("toxic").alias("n_toxic"), F.count("*").alias("n")), "words")
    telling = spelled.where("toxic = 1").join(counted.where("n_toxic > 2 AND odds > 2 AND n_toxic >= 0.7 * n"), "word")
    best = telling.groupBy("id").agg(F.max("odds").alias("best"))
    witness = telling.join(best, "id").where(F.col("odds") > F.col("best") - 1).groupBy("word").agg(F.count("*").alias("n"))
    good = witness.orderBy(F.desc("n"), "word").limit(toxic_words).collect()
    clean = counted.where("n_toxic < 0.7 * n")
    usual = clean.where("odds < 1").orderBy(F.desc("n"), "word").limit(usual_words).collect()
    other = clean.orderBy(F.xxhash64("word")).limit(other_words).collect()
    if not good:
        return Model(np.zeros(_SYMBOLS**3, np.float32), _LEAST, None)
    positive = [r.word for r in good]
    easy = {r.word for r in usual + other} - set(positive)

    def machine(hard: list[str]) -> Model:
        negative = sorted(easy | set(hard))
        rng = np.random.default_rng(7)
        marks = positive[: landmarks // 2] + hard[: landmarks // 3]
        marks += [w for w in (negative[i] for i in rng.permutation(len(negative))) if w not in set(marks)][: max(0, landmarks - len(marks))]
        base, triples = _features(marks)
        values, vectors = np.linalg.eigh(base @ base.T)
        some = values > 1e-6 * values[-1]
        into = vectors[:, some] / np.sqrt(values[some])
        every = positive + negative
        x = np.concatenate([_features(every[i : i + 500], triples)[0] @ base.T for i in range(0, len(every), 500)]) @ into
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        weight = np.where(y > 0, len(negative) / len(positive) / 4, 1.0)
        w, bias = _machine(x, y, weight, cost=20.0)
        table = np.zeros(_SYMBOLS**3, np.float32)
        table[triples] = base.T @ (into @ w)
        return Model(table, bias, None)

    # The clean words that it gets most wrong join the others, as landmarks too.
    model, hard = machine([]), []
    for _ in range(2):
        wrong = _margins(clean.select(F.lit(0).cast("long").alias("id"), F.col("word").alias("text")), model, True)
        worst = wrong.where("margin > -0.8").orderBy(F.desc("margin"), "text").limit(hard_words).collect()
        hard = list(dict.fromkeys([r.text for r in worst if r.text not in set(positive)] + hard))
        model = machine(hard)

    seen = _margins(sample.select("toxic", F.col("id"), "text"), model).join(sample.select("id", "toxic"), "id").collect()
    model.line = _line(np.array([(r.margin, r.second) for r in seen]), np.array([float(r.toxic) for r in seen]))
    return model


def _line(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression, classes smoothed as by Platt (1999): on the largest margin, and the second where that tells more."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def fitted(x: np.ndarray) -> tuple[np.ndarray, float]:
        x, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (target - p) - 1e-3 * w)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
        return w, float(-(toxic * np.log(p) + (1 - toxic) * np.log(1 - p)).mean())

    (slope, offset), loss = fitted(margins[:, :1])
    both, less = fitted(margins)
    if loss <= 1.2 * less + 0.01:
        return float(slope), 0.0, float(offset)
    return tuple(both.tolist())


def _margins(texts: DataFrame, model: Model, with_text: bool = False) -> DataFrame:
    """``id, margin, second`` (``text`` too if asked for) of ``id, text``."""
    table, bias = model.table, model.bias
    names = ["id", "margin", "second"] + ["text"] * with_text

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, at in flat.chunks(batches):
            best = text_margins(table, bias, flat.pieces(body, at))
            columns = [batch.column("id"), pa.array(best[:, 0]), pa.array(best[:, 1])] + [batch.column("text")] * with_text
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.select("id", "text").mapInArrow(rows, "id long, margin double, second double" + ", text string" * with_text)


def _chance(line: tuple[float, float, float] | None, margins: np.ndarray) -> np.ndarray:
    """Without anything learnt every score is 0."""
    if line is None:
        return np.zeros(len(margins))
    return 1 / (1 + np.exp(-(margins @ np.array(line[:2]) + line[2])))


def score(df: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted``, one row per row of ``df``, from its whole text alone.

    ``score`` (0 to 1) is the calibrated chance of a toxic label; ``predicted`` is 1 from ``threshold`` on.
    Null, empty and wordless texts have a score too, a low one. Repeated rows and null ids (not held out) are
    scored like others; other columns are ignored.
    """
    flat.small_batches(df)
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    table, bias, line = model.table, model.bias, model.line

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, at in flat.chunks(batches):
            value = _chance(line, text_margins(table, bias, flat.pieces(body, at)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(value)], names=["id", "score"])

    scored = texts.mapInArrow(rows, "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text scores ``threshold`` or more; nothing is moved between rows."""
    flat.small_batches(df)
    table, bias, line = model.table, model.bias, model.line

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(text_col), pa.array(np.arange(batch.num_rows))], names=["text", "row"])
            for part, body, at in flat.chunks(iter([texts])):
                clean = _chance(line, text_margins(table, bias, flat.pieces(body, at))) < threshold
                if clean.any():
                    yield batch.take(part.column("row").filter(pa.array(clean)))

    return df.mapInArrow(rows, df.schema)
