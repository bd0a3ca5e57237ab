"""Phrases of words that occur together more than alone, by tries of candidates walked by all positions at once.

1. Texts are cut into pieces and words once. Each slice of about half a megabyte becomes an array of 64-bit word codes
   with a zero between pieces, and the counts of its words. The corpus of codes and all that follows are written tables.
2. Level by level, the phrases of k words that are frequent enough (the Apriori property: all their parts are) become
   double-array tries, built in tasks and cut by hash so that none holds more than ``trie_phrases`` phrases; a trie is
   broadcast, and only that much at a time. numpy moves the states of all positions of a slice one level
   on together; a bincount over accepting states counts a task's phrases, and the counts are summed over tasks.
3. The same walk finds the candidates of k + 1 words: a word behind an accepted phrase (where one trie holds a
   language's level, only if the phrase that begins a word later is accepted as well). A task gathers them with counts up to
   the minimum, which tell whether a phrase is frequent, not how often; that is counted by the next level's trie. They meet by
   parts, as arrays, and the number of parts follows the number of words.
4. Scores, cuts and inclusion are joins and sums over the counted phrases, in decimals of 38 digits.

Word codes are hashes of the words. That no two of a language's words share one is checked over all words, and another
seed is taken if they do, so counts are exact. Nothing is kept by language in one task: words and
phrases are counted in each task first, and of a language's phrases only the best of each of many shares meet.

Defined cases: a null text is empty, a null language is ``und``, together with rows that say so. Texts of any length are
read in slices that begin with the last words of what lies before, so no phrase is lost at their edges; a single word may have any
length. Repeated rows count as often as they occur. Equal scores go by count, then by the
phrase's UTF-8 bytes. Only the two named columns are read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import mix, narrow
from docloom.session import materialize, settings

LONGEST = 4
LEAST = 30
TOP = 2000
SLICE = 1 << 19
TRIE_PHRASES = 400_000
PART_WORDS = 1_000_000  # words of the corpus for each part of the candidates

_BREAK = b"\xff"  # in no UTF-8 text
# What ends a piece, [.,;:!?\x0A-\x0D]. A tab parts words as a space does.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_CODES = ["w1", "w2", "w3", "w4"]
_HELD = 1 << 20  # distinct candidates that a task gathers before it hands them on
_BLOCK = 1 << 12  # phrases whose counts are handed on and summed together


def _table() -> bytes:
    table = bytearray(range(256))
    for byte in range(ord("A"), ord("Z") + 1):
        table[byte] = byte + 32
    for byte in _ENDS:
        table[byte] = _BREAK[0]
    table[9] = 32
    return bytes(table)


def slices(texts: list[bytes], size: int = SLICE) -> Iterator[bytes]:
    """The texts in lower case with breaks, one after the other, cut where no word is cut."""
    whole = _BREAK.join(texts).translate(_table())
    begin = 0
    while begin < len(whole):
        end = begin + size
        if end < len(whole):
            cuts = [at for at in (whole.find(b" ", end), whole.find(_BREAK, end)) if at >= 0]
            end = min(cuts, default=len(whole))
        yield whole[begin:end]
        begin = end


def encoded(docs: DataFrame, seed: int = 0, size: int = SLICE) -> DataFrame:
    """``(lang, codes, skip, words, own, counts)`` for each slice of ``(lang, text)``.

    ``codes`` are eight bytes each, zero for a break, the first ``skip`` of them from before the slice;
    ``words`` are the slice's distinct words with their codes and counts.
    """

    def cut(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        tail = np.zeros(0, np.int64)
        for part in slices(texts, size):
            words = part.replace(_BREAK, b" \xff ").split()
            codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words)).view(np.int64)
            distinct, first, counts = np.unique(codes, return_index=True, return_counts=True)
            named = [words[i] for i in first.tolist()]
            if _BREAK in named:
                at = named.index(_BREAK)
                codes[codes == distinct[at]] = 0
                named.pop(at)
                distinct, counts = np.delete(distinct, at), np.delete(counts, at)
            codes = np.concatenate([tail, codes])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]), pa.array([codes.tobytes()], pa.binary()), pa.array([len(tail)], pa.int32()),
                    pa.array([named], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                    pa.array([distinct], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                ],
                ["lang", "codes", "skip", "words", "own", "counts"],
            )
            tail = codes[-(LONGEST - 1) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting: dict[str, list[bytes]] = {}
            held: dict[str, int] = {}
            langs = batch.column("lang").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                if body := text.as_py():
                    lang = langs[i]
                    waiting.setdefault(lang, []).append(body)
                    held[lang] = held.get(lang, 0) + len(body)
                    if held[lang] >= size:
                        held[lang] = 0
                        yield from cut(lang, waiting.pop(lang))
            for lang, texts in waiting.items():
                yield from cut(lang, texts)

    return docs.mapInArrow(run, "lang string, codes binary, skip int, words array<string>, own array<long>, counts array<long>")


class Trie:
    """A double-array trie over phrases of one length.

    ``symbols`` are the words' codes in order; a word's symbol is its place among them plus one. From state ``s`` symbol ``c``
    leads to ``base[s] + c`` if ``check`` there is ``s``. ``phrase`` of a last state is the row of ``phrases``.
    """

    def __init__(self, phrases: np.ndarray):
        self.phrases = phrases
        self.symbols = np.unique(phrases)
        ids = np.searchsorted(self.symbols, phrases).astype(np.int64) + 1
        rows, depth = ids.shape
        order = np.lexsort(ids.T[::-1])
        ids = ids[order]
        size = 4 * (len(self.symbols) + rows * depth) + 1024
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.phrase = np.full(size, -1, np.int32)
        self.check[0] = 0
        states = np.zeros(rows, np.int64)  # of each phrase, as far as it is built
        for level in range(depth):
            new = np.ones(rows, bool)
            new[1:] = (states[1:] != states[:-1]) | (ids[1:, level] != ids[:-1, level])
            first = np.flatnonzero(new)
            parents, children = states[first], ids[first, level]
            begins = np.flatnonzero(np.diff(parents, prepend=-1))
            lengths = np.diff(np.append(begins, len(parents)))
            target = np.empty(len(first), np.int64)
            # The largest families look for room first.
            low = 1
            for family in np.argsort(-lengths, kind="stable"):
                own = slice(begins[family], begins[family] + lengths[family])
                at, low = self._room(children[own], low)
                self.base[parents[own.start]] = at
                target[own] = at + children[own]
                self.check[target[own]] = parents[own.start]
            states = target[np.cumsum(new) - 1]
        self.phrase[states] = order
        used = int(np.flatnonzero(self.check >= 0)[-1]) + 1 + len(self.symbols) + 1
        self._grow(used)
        self.base, self.check, self.phrase = self.base[:used], self.check[:used], self.phrase[:used]

    def _grow(self, size: int) -> None:
        more = size - len(self.base)
        if more > 0:
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check, self.phrase = [np.concatenate([a, np.full(more, -1, np.int32)]) for a in (self.check, self.phrase)]

    def _room(self, symbols: np.ndarray, low: int) -> tuple[int, int]:
        """The first base from ``low`` on where all ``symbols`` are free, and where to begin the next time."""
        at, window = low, 16
        while True:
            self._grow(at + window + int(symbols[-1]) + 1)
            tried = np.arange(at, at + window)
            free = (self.check[tried[:, None] + symbols] < 0).all(axis=1)
            if free.any():
                found = at + int(free.argmax())
                # A region without room for a family is left behind when the next ones are hardly smaller.
                return found, max(low, found - 64)
            at, window = at + window, min(1024, 2 * window)

    def walk(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions where a phrase begins, and which."""
        depth = self.phrases.shape[1]
        if len(codes) < depth or not len(self.symbols):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        at = np.searchsorted(self.symbols, codes)
        at[at == len(self.symbols)] = 0
        symbol = np.where((self.symbols[at] == codes) & (codes != 0), at + 1, 0)
        place = np.arange(len(codes) - depth + 1)
        state = np.zeros(len(place), np.int64)
        for level in range(depth):
            reached = symbol[place + level]
            target = self.base[state] + reached
            good = (reached > 0) & (self.check[target] == state)
            place, state = place[good], target[good]
        return place, self.phrase[state]


def _merged(phrase: np.ndarray, code: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct candidates, each a phrase and the word behind it, and the sums of ``seen``."""
    with np.errstate(over="ignore"):
        key = mix(code.view(np.uint64) + phrase.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    new = np.diff(key[order].view(np.int64), prepend=0) != 0
    new[:1] = True
    other = (np.diff(code[order], prepend=0) != 0) | (np.diff(phrase[order], prepend=0) != 0)
    if (other & ~new).any():  # two candidates with one key
        order = np.lexsort([phrase, code])
        new = (np.diff(code[order], prepend=0) != 0) | (np.diff(phrase[order], prepend=0) != 0)
        new[:1] = True
    first = np.flatnonzero(new)
    return phrase[order][first], code[order][first], np.add.reduceat(seen[order], first) if len(first) else seen[:0]


class _Gathered:
    """What a task has found of a language: counts of phrases, and the candidates behind them."""

    def __init__(self, phrases: int):
        self.counts = np.zeros(phrases, np.int64)
        self.candidates = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, phrase: np.ndarray, code: np.ndarray) -> None:
        found = _merged(phrase, code, np.ones(len(code), np.int64))
        self.candidates = tuple(np.concatenate(pair) for pair in zip(self.candidates, found))

    def hand_on(self, lang: str, parts: int, least: int, counts: bool) -> Iterator[pa.RecordBatch]:
        """Candidates by parts of all candidates, and counts by blocks of phrases, as bytes."""
        phrase, code, seen = _merged(*self.candidates)
        part = (mix(code.view(np.uint64) ^ mix(phrase.astype(np.uint64))) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        begins = np.flatnonzero(np.diff(part[order], prepend=-1))
        for some in np.split(order, begins[1:]) if len(order) else []:
            yield _row(lang, int(part[some[0]]), phrase[some], code[some], np.minimum(seen[some], least).astype(np.uint8))
        self.candidates = tuple(a[:0] for a in self.candidates)
        for begin in range(0, len(self.counts) if counts else 0, _BLOCK):
            held = np.flatnonzero(self.counts[begin : begin + _BLOCK])
            if len(held):
                yield _row(lang, -1 - begin // _BLOCK, held.astype(np.int32), self.counts[begin + held], np.zeros(0, np.uint8))


_WALKED = "lang string, part int, phrases binary, codes binary, seen binary"
_COUNTED = "lang string, k int, w1 long, w2 long, w3 long, w4 long, c long"


def _row(lang: str, part: int, *arrays: np.ndarray) -> pa.RecordBatch:
    blobs = [pa.array([a.tobytes()], pa.binary()) for a in arrays]
    return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([part], pa.int32()), *blobs], ["lang", "part", "phrases", "codes", "seen"])


def _walked(corpus: DataFrame, tries: dict, alone: set[str], parts: dict[str, int], least: int) -> DataFrame:
    """Counts of the phrases of broadcast ``tries``, by language, and the candidates behind them.

    Languages in ``alone`` have all their phrases in one trie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, _Gathered] = {}
        for batch in batches:
            langs, skips = batch.column("lang").to_pylist(), batch.column("skip").to_pylist()
            for lang, body, skip in zip(langs, batch.column("codes"), skips):
                if lang not in tries:
                    continue
                trie, codes = tries[lang].value, np.frombuffer(body.as_buffer(), np.int64)
                own = found.setdefault(lang, _Gathered(len(trie.phrases)))
                depth = trie.phrases.shape[1]
                place, phrase = trie.walk(codes)
                inside = place + depth - 1 >= skip  # a phrase belongs to the slice that has its last word
                own.counts += np.bincount(phrase[inside], minlength=len(trie.phrases))
                if depth == LONGEST:
                    continue
                behind = place + depth
                further = (behind < len(codes)) & (behind >= skip)
                if lang in alone:
                    begins = np.zeros(len(codes) + 1, bool)
                    begins[place] = True
                    further &= begins[place + 1]
                next_code = codes[behind[further]]
                own.add(phrase[further][next_code != 0], next_code[next_code != 0])
                if len(own.candidates[0]) > _HELD:
                    own.candidates = _merged(*own.candidates)
                    if len(own.candidates[0]) > _HELD // 2:
                        yield from own.hand_on(lang, parts[lang], least, False)
        for lang, own in found.items():
            yield from own.hand_on(lang, parts[lang], least, True)

    return corpus.mapInArrow(run, _WALKED)


def _codes_of(lang: pa.Array, phrases: np.ndarray, more: list[np.ndarray], values: np.ndarray) -> pa.RecordBatch:
    """Rows of ``_COUNTED``: phrases, and words behind them if there are ``more``."""
    columns = [*phrases.T, *more]
    k = np.full(len(values), len(columns), np.int32)
    columns += [np.zeros(len(values), np.int64)] * (LONGEST - len(columns))
    return pa.RecordBatch.from_arrays([lang, pa.array(k), *map(pa.array, columns), pa.array(values)], ["lang", "k", *_CODES, "c"])


def _level(corpus: DataFrame, phrases: DataFrame, k: int, least: int, trie_phrases: int, parts: dict[str, int]) -> DataFrame:
    """``(lang, k, w1.., c)``: the exact counts of ``phrases`` ``(lang, w1..)`` of ``k`` words, and the phrases of ``k + 1``
    words that occur ``least`` times, without exact counts."""
    spark = corpus.sparkSession
    # One row for each language, and for each trie.
    held = {r["lang"]: r["n"] for r in phrases.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    shards = {lang: -(-n // trie_phrases) for lang, n in held.items()}
    if not held:
        return spark.createDataFrame([], _COUNTED)
    number = F.create_map(*[F.lit(x) for pair in shards.items() for x in pair])
    shard = F.pmod(F.xxhash64(*_CODES[:k]), F.element_at(number, F.col("lang"))).cast("int")

    def built(group: pa.Table) -> pa.Table:
        codes = np.column_stack([group.column(c).to_numpy() for c in _CODES[:k]])
        return pa.table({"lang": group.column("lang").slice(0, 1), "shard": group.column("shard").slice(0, 1), "trie": pa.array([_packed(Trie(codes))], pa.binary())})

    made = phrases.withColumn("shard", shard).groupBy("lang", "shard").applyInArrow(built, "lang string, shard int, trie binary")
    made = materialize(made, "tries")
    alone, counted = {x for x in shards if shards[x] == 1}, None
    for turn in range(max(shards.values())):
        tries = {}
        for lang in [x for x in shards if shards[x] > turn]:
            row = made.where((F.col("lang") == lang) & (F.col("shard") == turn)).first()
            if row is not None:  # a shard may be empty
                tries[lang] = spark.sparkContext.broadcast(_unpacked(row["trie"]))
        counts = materialize(_summed(materialize(_walked(corpus, tries, alone, parts, least), "walked"), tries, least), "phrases")
        for trie in tries.values():
            trie.unpersist()
        counted = counts if counted is None else counted.union(counts)
    return counted


def _summed(walked: DataFrame, tries: dict, least: int) -> DataFrame:
    """The sums over all tasks: counts phrase by phrase, candidates part by part."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block for each that this task was dealt, however many tasks counted it.
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = held.setdefault((row["lang"], -1 - row["part"]), np.zeros(_BLOCK, np.int64))
                own[np.frombuffer(row["phrases"], np.int32)] += np.frombuffer(row["codes"], np.int64)
        for (lang, block), own in held.items():
            some = np.flatnonzero(own)
            yield _codes_of(pa.array([lang] * len(some), pa.string()), tries[lang].value.phrases[block * _BLOCK + some], [], own[some])

    def frequent(group: pa.Table) -> pa.Table:
        phrase, code, seen = [np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in (("phrases", np.int32), ("codes", np.int64), ("seen", np.uint8))]
        phrase, code, seen = _merged(phrase, code, seen.astype(np.int64))
        good = seen >= least
        lang = group.column("lang")[0].as_py()
        rows = _codes_of(pa.array([lang] * int(good.sum()), pa.string()), tries[lang].value.phrases[phrase[good]], [code[good]], seen[good])
        return pa.Table.from_batches([rows])

    counts = walked.where("part < 0").select("lang", "part", "phrases", "codes").repartition("lang", "part").mapInArrow(summed, _COUNTED)
    candidates = walked.where("part >= 0")
    return counts.union(candidates.groupBy("lang", "part").applyInArrow(frequent, _COUNTED))


def _packed(trie: Trie) -> bytes:
    sink = pa.BufferOutputStream()
    values = [trie.phrases.ravel(), trie.symbols, trie.base, trie.check, trie.phrase, np.array(trie.phrases.shape)]
    for value in values:
        pa.ipc.write_tensor(pa.Tensor.from_numpy(value), sink)
    return sink.getvalue().to_pybytes()


def _unpacked(body: bytes) -> Trie:
    source = pa.BufferReader(bytes(body))
    flat, symbols, base, check, phrase, shape = [pa.ipc.read_tensor(source).to_numpy().copy() for _ in range(6)]
    trie = Trie.__new__(Trie)
    trie.phrases, trie.symbols, trie.base, trie.check, trie.phrase = flat.reshape(shape), symbols, base, check, phrase
    return trie


def counted_phrases(docs: DataFrame, least: int = LEAST, trie_phrases: int = TRIE_PHRASES, text: str = "text", lang: str = "lang",
                    size: int = SLICE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lang, k, w1..w4, a)`` of all phrases of 1 to 4 words that occur ``least`` times, the frequent words
    ``(lang, code, word)``, and ``(lang, n)``."""
    texts = narrow(docs, text=text, lang=lang).withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit("und")))
    seed = 0
    while True:
        corpus = materialize(encoded(texts, seed, size), "corpus")
        each = corpus.select("lang", F.explode(F.arrays_zip("words", "own", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.own").alias("code"), F.col("w.counts").alias("c"))
        words = materialize(each.groupBy("lang", "word").agg(F.first("code").alias("code"), F.sum("c").alias("a")), "words")
        shared = words.groupBy("lang", "code").agg(F.count("*").alias("n")).where("n > 1 or code = 0")
        if shared.isEmpty():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = materialize(words.where(F.col("a") >= least), "frequent")
    corpus = corpus.select("lang", "codes", "skip")
    # One row for each language.
    parts = {r["lang"]: 1 + r["n"] // PART_WORDS for r in totals.collect()}
    nothing = F.lit(0).cast("long")
    candidates = frequent.select("lang", F.col("code").alias("w1"), *[nothing.alias(c) for c in _CODES[1:]])
    found = []
    for k in range(1, LONGEST + 1):
        counted = _level(corpus, candidates, k, least, trie_phrases, parts)
        found.append(counted.where(F.col("k") == k))
        candidates = counted.where(F.col("k") == k + 1).select("lang", *_CODES)
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole.withColumnRenamed("c", "a"), frequent.select("lang", "code", "word"), totals


def _part(first: int, length: int) -> list[Column]:
    """The codes of a phrase's words from ``first``, ``length`` of them, filled up with zeros."""
    return [F.col(_CODES[first + i]) if i < length else F.lit(0).cast("long") for i in range(LONGEST)]


def _parts(phrases: DataFrame, cuts: Column) -> DataFrame:
    return phrases.select("*", F.explode(cuts).alias("part"))


def _named(length: int, first: int) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip(_part(first, length), _CODES)])


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of texts and codes stay near the size of what is made of them at once."""
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}):
        yield


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, trie_phrases: int = TRIE_PHRASES, text: str = "text",
                 lang: str = "lang", size: int = SLICE, shares: int = 64) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to 4 words.

    ``a`` occurrences of the phrase, ``l`` and ``r`` of its parts at the lowest-scoring cut, ``n`` of all words; ``score`` is
    2,000,000 a / (l + r), rounded down. Phrases within a longer one that occurs at least 0.8 times as often are left out.
    """
    with _small_batches(docs.sparkSession):
        phrases, words, totals = counted_phrases(docs, least, trie_phrases, text, lang, size)
    phrases = materialize(phrases.withColumn("key", F.struct(*_CODES)).select("lang", "k", "key", "a"), "phrases")
    several = phrases.where("k > 1").select("lang", "k", "key", "a", *[F.col("key")[c].alias(c) for c in _CODES])

    # Cuts: each gets the counts of its two parts.
    def cut(k: int) -> Column:
        return F.array(*[F.struct(F.lit(j).alias("j"), _named(j, 0).alias("left"), _named(k - j, j).alias("right")) for j in range(1, k)])

    def by_length(of) -> Column:
        made = F.when(F.col("k") == 2, of(2))
        for k in range(3, LONGEST + 1):
            made = made.when(F.col("k") == k, of(k))
        return made

    cuts = _parts(several, by_length(cut)).select("lang", "key", "a", F.col("part.j").alias("j"), F.col("part.left").alias("left"), F.col("part.right").alias("right"))
    counts = phrases.select("lang", "key", "a")
    cuts = cuts.join(counts.select("lang", F.col("key").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("key").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    exact = "cast(cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as long)"
    scored = cuts.withColumn("score", F.expr(exact)).groupBy("lang", "key").agg(
        F.min(F.struct("score", "j", "l", "r")).alias("worst"), F.first("a").alias("a")
    )

    # Phrases inside longer ones.
    def inner(k: int) -> Column:
        return F.array(*[_named(length, i) for length in range(2, k) for i in range(k - length + 1)])

    inside = _parts(several.where("k > 2"), by_length(lambda k: inner(k) if k > 2 else F.lit(None)))
    inside = inside.groupBy("lang", F.col("part").alias("key")).agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "key"], "left")
    left = left.where(F.expr("longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * 80"))
    left = left.select("lang", "a", "worst.l", "worst.r", "worst.score", *[F.col("key")[c].alias(c) for c in _CODES])

    for i, code in enumerate(_CODES):
        named = words.select("lang", F.col("code").alias(code), F.col("word").alias(f"word{i}"))
        left = left.join(named, ["lang", code], "left")
    left = left.select("lang", F.concat_ws(" ", *[f"word{i}" for i in range(LONGEST)]).alias("phrase"), "a", "l", "r", "score")
    left = materialize(left, "scored")

    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    first = left.withColumn("share", share)
    first = first.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
