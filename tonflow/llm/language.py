"""Language identification, words first.

A word that was seen in training adds its log frequency in each language.  For a word never
seen, its character n-grams answer instead: the longest length at which any of them is known,
then the next shorter one, each step at a discount.

A model holds its most frequent words and n-grams; the tables of all of them stay in Spark.
Words that workers do not hold are looked up there, so what is held changes no score.
Logarithms are whole multiples of ``1 / STEP``, so sums are exact in any order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, pieces, stored

UNKNOWN = "und"
#: Runs of letters, and of signs like fractions; words with such a sign are cut again.
_RUNS, _LETTERS = re.compile(r"[^\W\d_]+"), regex.compile(r"\p{L}+")
STEP = float(1 << 19)
#: Places of a word whose n-grams are made at once.
BLOCK = 1000
#: Bytes of text whose words are looked up together where workers don't hold them.
LOOKED_UP = 32 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    entries: dict[str, int]
    """Row by word, or by ``n:`` and an n-gram of a word with its ends marked ``^`` and ``$``."""
    logs: np.ndarray
    longest: int
    words: DataFrame | None = None
    """All words with their logs, and ``grams`` likewise; None if ``entries`` has all of both."""
    grams: DataFrame | None = None


def learn(
    labelled: DataFrame,
    text: str = "text",
    language: str = "lang",
    longest: int = 4,
    most_words: int = 150_000,
    most_grams: int = 50_000,
) -> LanguageModel:
    """Count words and n-grams of all labelled texts; rows without text or language don't count.

    Counting covers every row, and every word and n-gram counts in the model.  Workers hold the
    ``most_words`` most frequent words; where that or ``most_grams`` leaves any out,
    ``identify`` looks up the others in tables.
    """
    words = labelled.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(language).alias("language"),
        F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\p{L}+"), F.lit(0))).alias("entry"),
    )
    # A language counts if any of its texts has a word; one counter per language then needs one shuffle.
    spoken = labelled.where(F.col(language).isNotNull() & F.col(text).rlike(r"\p{L}"))
    languages = sorted(r[0] for r in spoken.select(language).distinct().collect())
    counters = [f"n{i}" for i in range(len(languages))]
    met = [F.count(F.when(F.col("language") == x, 1)).alias(c) for c, x in zip(counters, languages, strict=True)]
    word_counts = _counted(words, met)
    spread = _spread(word_counts, "entry", longest, *counters).withColumnRenamed("gram", "entry")
    gram_counts = _counted(spread, [F.sum(c).alias(c) for c in counters])
    all_words = _with_logs(word_counts, counters, F.lit(0))
    all_grams = _with_logs(gram_counts, counters, _size("entry"))
    words_kept, word_logs, words_whole = _frequent(all_words, len(languages), most_words)
    grams_kept, gram_logs, grams_whole = _frequent(all_grams, len(languages), most_grams)
    entries = {e: i for i, e in enumerate(words_kept + grams_kept)}
    tables = () if words_whole and grams_whole else (all_words, all_grams)
    return LanguageModel(languages, entries, np.concatenate([word_logs, gram_logs]), longest, *tables)


def _size(entry: str) -> Column:
    return F.substring_index(F.col(entry), ":", 1).cast("int")


def _counted(rows: DataFrame, counts: list[Column]) -> DataFrame:
    """A stored row per entry with its counts; without languages there is no row to count."""
    return stored(rows.groupBy("entry").agg(*counts or [F.count("*").alias("n")]))


def _spread(rows: DataFrame, word: str, longest: int, *carry: str, shortest: int = 1) -> DataFrame:
    """A row ``gram`` for each n-gram at each place of a word; the columns of ``carry`` go along.

    Long words are cut into blocks of places, each with the letters that its last n-grams need.
    A block too short for any n-gram has a row without one.
    """
    whole = F.concat(F.lit("^"), F.col(word), F.lit("$"))
    cut = F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{1,{BLOCK + longest - 1}}})).{{1,{BLOCK}}}"), F.lit(1))
    blocks = rows.select(*carry, F.explode(F.when(F.length(whole) <= BLOCK, F.array(whole)).otherwise(cut)).alias("__block"))
    marked = F.col("__block")

    def grams(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.length(marked) - size + 1))
        cut = F.transform(starts, lambda i: F.concat(F.lit(f"{size}:"), F.substring(marked, i, F.lit(size))))
        return F.when(F.length(marked) >= size, cut).otherwise(F.array().cast("array<string>"))

    return blocks.select(*carry, F.explode_outer(F.flatten(F.array(*[grams(k) for k in range(shortest, longest + 1)]))).alias("gram"))


def _with_logs(counts: DataFrame, counters: list[str], kind: Column) -> DataFrame:
    """(entry, total, logs): per language the smoothed log frequency among entries of its kind."""
    sums = [F.sum(c).alias(c) for c in counters]
    kinds = {r["kind"]: r for r in counts.groupBy(kind.alias("kind")).agg(F.count("*").alias("rows"), *sums).collect()}
    rows = sum(r["rows"] for r in kinds.values())

    def log(i: int) -> Column:
        whole = F.create_map(*[F.lit(x) for k, r in kinds.items() for x in (k, r[f"n{i}"] + 0.1 * rows)])
        return F.rint(F.log((F.col(f"n{i}") + 0.1) / whole[kind]) * STEP) / STEP

    logs = F.array(*[log(i) for i in range(len(counters))] if kinds else []).cast("array<float>")
    total = sum((F.col(c) for c in counters), F.lit(0).cast("long"))
    return counts.select("entry", total.alias("total"), logs.alias("logs"))


def _frequent(entries: DataFrame, width: int, most: int) -> tuple[list[str], np.ndarray, bool]:
    """The ``most`` entries of the highest totals, their logs, and whether these are all.

    How many entries have which total tells where to cut, so that only what is kept is sent to
    the driver; of the entries at the cut the first by spelling are kept.
    """
    sizes = entries.groupBy("total").agg(F.count("*").alias("n"))
    cut, room = 0, most
    for r in sizes.orderBy(F.desc("total")).toLocalIterator():
        if r["n"] > room:
            cut = r["total"]
            break
        room -= r["n"]
    kept = entries.where(F.col("total") > cut).toArrow()
    if cut:
        kept = pa.concat_tables([kept, entries.where(F.col("total") == cut).orderBy("entry").limit(room).toArrow()])
    kept = kept.take(pa.compute.sort_indices(kept.select(["total", "entry"]), [("total", "descending"), ("entry", "ascending")]))
    logs = np.array(pa.compute.list_flatten(kept["logs"]).to_numpy(), np.float32).reshape(kept.num_rows, width)
    return kept["entry"].to_pylist(), logs, not cut


class _Scorer(dict):
    """Row of a word in ``table``; rows of unseen words are made on demand, ``room`` at most."""

    def __init__(self, model: LanguageModel, room: int = 100_000, discount: float = 0.4):
        super().__init__((k, v) for k, v in model.entries.items() if ":" not in k)
        self.model, self.room, self.discount = model, room, discount
        self.table = np.concatenate([model.logs, np.zeros((room, len(model.languages)), np.float32)])
        self.own: list[str] = []

    def __missing__(self, word: str) -> int:
        row = len(self.model.logs) + len(self.own)
        self.table[row] = self._unseen(word)
        self.own.append(word)
        self[word] = row
        return row

    def _unseen(self, word: str) -> np.ndarray:
        marked, entries = f"^{word}$", self.model.entries
        for size in range(min(self.model.longest, len(marked)), 0, -1):
            total, n = np.zeros(len(self.model.languages)), 0
            for at in range(0, len(marked) - size + 1, BLOCK):
                places = range(at, min(at + BLOCK, len(marked) - size + 1))
                found = [row for i in places if (row := entries.get(f"{size}:{marked[i:i + size]}")) is not None]
                total += self.model.logs[found].sum(axis=0, dtype=np.float64)
                n += len(found)
            if n:
                weight = self.discount ** (self.model.longest - size)
                return np.rint(weight * (total / n) * STEP) / STEP
        return np.zeros(len(self.model.languages), np.float32)

    def sums(self, words: list[str]) -> np.ndarray:
        total = np.zeros(len(self.model.languages))
        for at in range(0, len(words), self.room):
            some = words[at : at + self.room]
            if len(self.own) + len(some) > self.room:
                for word in self.own:
                    del self[word]
                self.own.clear()
            rows = np.fromiter(map(self.__getitem__, some), np.int64, len(some))
            total += self.table[rows].sum(axis=0, dtype=np.float64)
        return total

    def words(self, text: str | None) -> list[str]:
        """The words of a text, as they are learnt; none where it is to be ``und``."""
        if not text or not self.model.languages:
            return []
        words = _RUNS.findall(text.lower())
        if not "".join(words).isalpha():
            words = [x for w in words for x in ([w] if w.isalpha() else _LETTERS.findall(w))]
        return words

    def predict(self, text: str | None) -> tuple[str, float]:
        words = self.words(text)
        return _verdict(self.model.languages, self.sums(words) if words else None, len(words))

    def held(self, words: list[str], places: _Places) -> tuple[np.ndarray, np.ndarray]:
        """The sums over the words that the model holds, and the places of all others, sorted."""
        total, others = np.zeros(len(self.model.languages)), [np.zeros(0, np.int32)]
        for at in range(0, len(words), self.room):
            some = words[at : at + self.room]
            rows = np.fromiter(map(self.get, some, repeat(-1)), np.int64, len(some))
            total += self.table[rows[rows >= 0]].sum(axis=0, dtype=np.float64)
            unheld = np.flatnonzero(rows < 0).tolist()
            others.append(np.fromiter((places[some[i]] for i in unheld), np.int32, len(unheld)))
        return total, np.sort(np.concatenate(others))


class _Places(dict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


def _verdict(languages: list[str], total: np.ndarray | None, n_words: int) -> tuple[str, float]:
    if not n_words:
        return UNKNOWN, 0.0
    # long texts would make every score 1: at most 25 words' worth of evidence counts
    evidence = total / n_words * min(n_words, 25)
    odds = np.exp(evidence - evidence.max())
    best = int(odds.argmax())
    return languages[best], float(odds[best] / odds.sum())


def _backed_off(unseen: DataFrame, model: LanguageModel, discount: float = 0.4) -> DataFrame:
    """(word, logs) of words that are not in the model; one without any known n-gram has no row.

    The longest n-grams are looked up first, and only words that had none go on to shorter ones.
    """
    words, found = unseen.select("word").distinct(), []
    for size in range(model.longest, 0, -1):
        grams = model.grams.where(_size("entry") == size).select(F.col("entry").alias("gram"), "logs")
        met = _spread(words, "word", size, "word", shortest=size).join(grams, "gram", "left")
        sums = [F.sum(F.col("logs")[i].cast("double")) for i in range(len(model.languages))]
        judged = stored(met.groupBy("word").agg(F.count("logs").alias("n"), F.array(*sums).alias("sums")))
        weight = F.lit(discount ** (model.longest - size))
        backed = [F.rint(weight * (F.col("sums")[i] / F.col("n")) * STEP) / STEP for i in range(len(model.languages))]
        found.append(judged.where(F.col("n") > 0).select("word", F.array(*backed).cast("array<float>").alias("logs")))
        words = judged.where(F.col("n") == 0).select("word")
    return reduce(DataFrame.unionByName, found)


def _answers(asked: DataFrame, model: LanguageModel) -> DataFrame:
    """(block, at, logs) for the words of each block: from the table of words, else from n-grams."""
    known = model.words.select(F.col("entry").alias("word"), "logs")
    met = stored(
        asked.join(known, "word", "left").select("block", "at", F.when(F.col("logs").isNull(), F.col("word")).alias("word"), "logs")
    )
    unseen = met.where(F.col("logs").isNull()).select("block", "at", "word")
    backed = unseen.join(_backed_off(unseen, model), "word").select("block", "at", "logs")
    return met.where(F.col("logs").isNotNull()).select("block", "at", "logs").unionByName(backed)


def identify(
    docs: DataFrame, model: LanguageModel, carry: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Language of every whole text: columns of ``carry``, ``lang_pred`` and ``score`` (0 to 1).

    A text that is null or has no letter, and every text under a model without languages, is
    ``und`` with score 0.  Languages that tie are decided by name.  Repeated rows are
    judged each for itself; further columns are left out.
    """
    code_on_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, words=None, grams=None))
    schema = ", ".join(
        [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry] + ["lang_pred string", "score double"]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in pieces(batches, "__text"):
            scorer = scorer or _Scorer(shared.value)
            found = [scorer.predict(x) for x in batch.column(len(carry)).to_pylist()]
            columns = [batch.column(i) for i in range(len(carry))]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "lang_pred", "score"])

    texts = docs.select(*carry, F.col(text).alias("__text"))
    if model.words is None:
        return texts.mapInArrow(judge, schema)

    own = len(carry)

    def sum_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, places, size = None, _Places(), 0
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, "__text"):
            scorer = scorer or _Scorer(shared.value)
            if size >= LOOKED_UP:
                places, size, block = _Places(), 0, block + 1
            base = len(places)
            words = [scorer.words(x) for x in batch.column(own).to_pylist()]
            held = [scorer.held(w, places) for w in words]
            size += pa.compute.sum(pa.compute.binary_length(batch.column(own))).as_py() or 0
            lengths = [0, *(len(x[1]) for x in held)]
            others = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), np.concatenate([x[1] for x in held]))
            n = batch.num_rows
            columns = [batch.column(i) for i in range(own)]
            columns += [
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([x[0] for x in held], pa.list_(pa.float64())),
                pa.array(np.full(n, block)),
                others,
                pa.array(np.full(n, base, np.int32)),
                pa.array([list(islice(places, base, None)), *[None] * (n - 1)], pa.list_(pa.string())),
            ]
            names = ["__words", "__sums", "__block", "__others", "__base", "__met"]
            yield pa.RecordBatch.from_arrays(columns, [*carry, *names])

    def conclude(rows: pa.Table, answers: pa.Table) -> pa.Table:
        languages = shared.value.languages
        # Words without an answer have no known n-gram and add nothing.
        lists = rows["__others"].combine_chunks()
        size = max((pa.compute.max(lists.flatten()).as_py() or 0) + 1, (pa.compute.max(answers["at"]).as_py() or 0) + 1)
        logs = np.zeros((size, len(languages)))
        if answers.num_rows:
            flat = answers["logs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            logs[answers["at"].to_numpy()] = flat.reshape(-1, len(languages))
        found = []
        for n, held, places in zip(rows["__words"].to_pylist(), rows["__sums"].to_pylist(), lists, strict=True):
            added = logs[places.values.to_numpy(zero_copy_only=False)].sum(axis=0)
            found.append(_verdict(languages, np.array(held) + added, n))
        columns = [rows[c] for c in columns_of_carry]
        columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
        return pa.table(columns, [*carry, "lang_pred", "score"])

    # Words that workers don't hold are numbered within a block of texts; each block names them once
    # and gets one table of answers back, so neither grows with how often a block has a word.
    columns_of_carry = [f"__{i}" for i in range(own)]
    fields = schema.removesuffix("lang_pred string, score double") + (
        "__words bigint, __sums array<double>, __block bigint, __others array<int>, __base int, __met array<string>"
    )
    parts = stored(texts.mapInArrow(sum_held, fields))
    met = parts.where(F.size("__met") > 0).select("__block", "__base", F.posexplode("__met").alias("i", "word"))
    asked = met.select(F.col("__block").alias("block"), (F.col("__base") + F.col("i")).alias("at"), "word")
    answers = _answers(asked, model)
    rows = parts.select(
        "__block", *[F.col(c).alias(n) for c, n in zip(carry, columns_of_carry, strict=True)], "__words", "__sums", "__others"
    )
    return rows.groupBy("__block").cogroup(answers.groupBy("block")).applyInArrow(conclude, schema)
