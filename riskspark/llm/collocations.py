"""Phrase collocations by dynamic itemset counting.

Texts are dealt into ``shards``, which are scanned one after the other, round
and round.  Words are counted from the first shard on.  A longer phrase is
counted from the first scan after both phrases one word shorter (it without its
last and without its first word) have reached ``min_count`` in what was scanned
so far, and until it has seen every shard once.  Lengths are thus counted side
by side, and the scans end when no phrase is waiting for a shard.

Texts are cut into words once; the shards hold 64-bit hashes of the words.
Between scans the counts are a table: (key, occurrences, mark).  The mark is the
first scan, or ``REACHED`` plus the number of the scan by whose end the phrase had
reached ``min_count``.  A phrase's key is a 64-bit hash
of its language and words.  Which phrases have reached ``min_count``, and when,
is sent to the tasks as a map of fixed size, by key; of phrases that share a
place the earliest counts, so a phrase may be counted sooner than it has to be,
never later and never for less than a whole round.  What has completed its round
without reaching ``min_count`` leaves the table.  The words of what did reach it
are looked up at the end, each phrase in the first part of the shards that has
it; a row of a shard names the words that its task met there first.  Two given
words, or two given phrases of a language, are one with probability 2^-61.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import Sent, discard, ready_workers, written

#: The contract's piece ends, and A-Z to a-z; a piece end becomes a token of its own, which no word can be.
MARK = b"."
TABLE = bytes(MARK[0] if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
IN_WORD = np.array([c not in b" \t" + MARK for c in range(256)])
#: Bytes of text in a row of a shard, tokens whose phrases are looked up at once, keys that are counted at once, and counted keys a task holds before it passes them on.
ROW_BYTES = 1 << 18
BUFFER = 1 << 18
RAW_KEYS = 1 << 21
HELD_KEYS = 1 << 20
#: A shard's rows are in so many parts; most frequent phrases are in one part.
PARTS = 16
#: Partitions of the shards that one task reads new words of; one task in so many is read first.
NAMED_PARTITIONS = 8
NAMED_FIRST = 64
#: Added to a scan's number in a mark; there are at most 100 scans.
REACHED = 128
#: Words a task remembers having met, at most.
KNOWN_WORDS = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """The lower-cased words of a text; ``MARK`` ends a piece."""
    return text.translate(TABLE).replace(MARK, b" . ").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(32)
    y ^= x
    y *= MIX
    y ^= y >> np.uint64(29)
    return y


class Words:
    """64-bit hashes of words; ``MARK`` is 0.  ``new`` has the words met since it was last emptied, as far as ``seen`` remembers those met before, ``low`` the lower halves of their hashes."""

    def __init__(self):
        self.seen = np.zeros(KNOWN_WORDS, np.uint64)
        self.new: list[bytes] = []
        self.low: list[np.ndarray] = []

    def __getitem__(self, word: bytes) -> int:
        return 0 if word == MARK else int(self.codes([word])[0])

    def codes(self, words: list[bytes]) -> np.ndarray:
        """The hashes of different words."""
        codes = codes_of(words)
        # a word is remembered until another takes its place
        place = (codes % np.uint64(KNOWN_WORDS)).view(np.int64)
        new = np.flatnonzero(self.seen[place] != codes)
        self.seen[place[new]] = codes[new]
        self.new += [words[i] for i in new.tolist()]
        self.low.append(codes[new].astype(np.uint32))
        return codes


def codes_of(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; 0 is a piece end."""
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    codes[codes == 0] = 1
    return codes


def hashed(texts: list[bytes], words: Words) -> np.ndarray:
    """The hashes of the ``tokens`` of several texts, with a piece end after each; a word is hashed once."""
    text = np.frombuffer(MARK.join([*texts, b""]).translate(TABLE), np.uint8)
    inside = IN_WORD[text]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    offsets = np.zeros(len(edges) // 2 + 1, np.int64)
    np.cumsum(edges[1::2] - edges[::2], out=offsets[1:])
    found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text[inside])]).dictionary_encode()
    # no word holds a space
    own = pc.binary_join(pa.LargeListArray.from_arrays([0, len(found.dictionary)], found.dictionary.cast(pa.binary())), b" ")[0].as_py().split()
    first = text == MARK[0]
    first[edges[::2]] = True
    first = text[first] != MARK[0]
    codes = np.zeros(len(first), np.uint64)
    codes[first] = words.codes(own)[found.indices.to_numpy()]
    return codes


class Grams:
    """Keys of all phrases of a run of word hashes: ``keys(n)[i]`` is that of the n words from place i, ``valid(n)`` says where there is one."""

    def __init__(self, codes: np.ndarray, lang: str):
        self.codes = codes
        self.fine = [codes > 0]
        # an id of the language starts every key
        self.chain = [_mixed(codes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1)))]

    def keys(self, n: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        while len(self.chain) < n:
            last, k = self.chain[-1], len(self.chain)
            self.chain.append(_mixed(last[:len(last) - 1] * MIX + self.codes[k:]) if len(last) > 1 else last[:0])
        # the low three bits of a key are the phrase's length
        out = self.chain[n - 1][at] & ~np.uint64(7)
        out |= np.uint64(n)
        return out

    def valid(self, n: int) -> np.ndarray:
        while len(self.fine) < n:
            last, k = self.fine[-1], len(self.fine)
            self.fine.append(last[:-1] & self.fine[0][k:] if len(last) > 1 else last[:0])
        return self.fine[n - 1]


def since(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The scan after which each key's place was taken; 0 where it is free."""
    return places[(keys & np.uint64(len(places) - 1)).view(np.int64)]


def active(grams: Grams, n: int, places: np.ndarray, after: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a phrase of n >= 2 words starts whose two shorter phrases are in the map and whose round began after scan ``after``, and the scan it began with."""
    taken = since(places, grams.keys(n - 1))
    if len(taken) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    began = np.maximum(taken[:-1], taken[1:])
    at = np.flatnonzero(grams.valid(n) & (np.minimum(taken[:-1], taken[1:]) > 0) & (began > max(0, after)))
    return at, began[at]


def coded(batches) -> Iterator[pa.RecordBatch]:
    """Rows (lang, codes, size, new, low) of many texts of one language each, kept apart by a piece end.

    ``size`` counts the words, ``new`` are the words hashed since the row before,
    between spaces, and ``low`` the lower halves of their hashes.
    """
    words = Words()
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def row(lang: str):
        codes = hashed(held.pop(lang), words)
        new, low = b" ".join(words.new), np.concatenate(words.low)
        words.new, words.low = [], []
        del sizes[lang]
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([codes.tobytes()], pa.binary()), pa.array([int(np.count_nonzero(codes))], pa.int64()),
                                           pa.array([new], pa.binary()), pa.array([low.tobytes()], pa.binary())], names=["lang", "codes", "size", "new", "low"])

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            own = text.as_buffer().to_pybytes()
            held.setdefault(lang, []).append(own)
            sizes[lang] = sizes.get(lang, 0) + len(own) + 1
            if sizes[lang] > ROW_BYTES:
                yield row(lang)
    for lang in list(held):
        yield row(lang)


def runs(batches) -> Iterator[tuple[str, np.ndarray]]:
    """(language, word hashes) of several rows of a shard at once."""
    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    for b in batches:
        for lang, codes in zip(b.column("lang").to_pylist(), b.column("codes")):
            held.setdefault(lang, []).append(np.frombuffer(codes.as_buffer(), np.uint64))
            sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
            if sizes[lang] > BUFFER:
                yield lang, np.concatenate(held.pop(lang))
                del sizes[lang]
    for lang in list(held):
        yield lang, np.concatenate(held.pop(lang))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, occurrences) of several such pairs as one."""
    if len(parts) == 1:
        return parts[0]
    keys, times = (np.concatenate([p[c] for p in parts]) for c in range(2))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times[order], first)


def _taken(counts: DataFrame, max_words: int, size_log2: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scans) of the phrases of at most ``max_words`` words that have reached the threshold: one of 2^size_log2 places each, the earliest scan of a place."""
    rows = counts.where((F.col("mark") > REACHED) & (F.col("key").bitwiseAND(F.lit(7)) <= F.lit(max_words)))
    rows = rows.groupBy(F.col("key").bitwiseAND(F.lit((1 << size_log2) - 1)).cast("int").alias("place")).agg((F.min("mark") - REACHED).cast("byte").alias("since")).toArrow()
    return rows.column("place").to_numpy(), rows.column("since").to_numpy().astype(np.uint8)


def _lengths(places: np.ndarray) -> list[int]:
    """The lengths of the phrases of some places, which are low bits of keys."""
    return np.unique(places & 7).tolist()


def _places(taken: tuple[np.ndarray, np.ndarray], size_log2: int) -> np.ndarray:
    out = np.zeros(1 << size_log2, np.uint8)
    out[taken[0]] = taken[1]
    return out


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100,
                     shards: int = 3, size_log2: int = 22) -> DataFrame:
    """(lang, phrase, words, n): the words and phrases of at most ``max_words`` words that occur ``min_count`` times or more in their language.

    ``phrase`` is its words joined by single spaces, ``words`` their number.  One
    more row a language, with an empty phrase of 0 words, has the number of all
    its word occurrences, if it has any.  The map of 2^size_log2 places should
    have some eight a frequent phrase; more phrases cost time, not counts.
    """
    if shards * max_words > 100:
        raise ValueError("at most 100 scans")
    spark = docs.sparkSession
    ready_workers(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    dealt = texts.mapInArrow(coded, "lang string, codes binary, size long, new binary, low binary").withColumn("id", F.monotonically_increasing_id())
    dealt = written(dealt.select("lang", "codes", "size", "new", "low", F.shiftright("id", 33).alias("task"), F.expr(f"cast(id div {shards} % {PARTS} as int)").alias("part"),
                                 F.expr(f"cast(id % {shards} as int)").alias("shard")), "shard", compression="zstd")

    def counter(scan: int, maps: Sent | None, lengths: list[int]):
        def count(batches):
            # keys, and (keys, occurrences), by the scan with which their round began: all occurrences of a phrase have the same
            raw: dict[int, list[np.ndarray]] = {}
            parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

            def counted():
                for began in list(raw):
                    parts.setdefault(began, []).append(np.unique(np.concatenate(raw.pop(began)), return_counts=True))

            def size():
                return sum(len(p[0]) for own in parts.values() for p in own)

            def out():
                for began in list(parts):
                    keys, n = _summed(parts.pop(began))
                    for s in range(0, len(keys), 1 << 16):
                        own = keys[s:s + (1 << 16)].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n[s:s + (1 << 16)]), pa.array(np.full(len(own), began, np.int16))], names=["key", "c", "mark"])

            held = 0
            for lang, codes in runs(batches):
                grams = Grams(codes, lang)
                if scan < shards:
                    own = grams.keys(1, grams.valid(1))
                    raw.setdefault(0, []).append(own)
                    held += len(own)
                for n in lengths:
                    at, began = active(grams, n, maps.built(_places, size_log2), scan - shards)
                    own = grams.keys(n, at)
                    held += len(own)
                    for k in np.unique(began).tolist():
                        raw.setdefault(k, []).append(own[began == k])
                if held > RAW_KEYS:
                    counted()
                    held = 0
                    if size() > HELD_KEYS:
                        for k in parts:
                            parts[k] = [_summed(parts[k])]
                        if size() > HELD_KEYS // 2:
                            yield from out()
            counted()
            yield from out()
        return count

    counts, scan, taken = None, 0, None
    while scan < shards or (taken[1] > scan - shards).any():
        maps, lengths = None, []
        if scan:
            # only phrases one word longer than some whose round led to the threshold lately are still counted
            maps, lengths = Sent(spark, taken), [n + 1 for n in _lengths(taken[0][taken[1] > scan - shards])]
        rows = dealt.where(F.col("shard") == scan % shards).select("lang", "codes").mapInArrow(counter(scan, maps, lengths), "key long, c long, mark short")
        if counts is not None:
            rows = rows.unionByName(counts)
        # a task's keys are nearly all different: they are summed where they meet
        rows = rows.repartition("key").groupBy("key").agg(F.sum("c").alias("c"), F.max("mark").alias("mark"))
        reached = F.when((F.col("mark") < REACHED) & (F.col("c") >= min_count), REACHED + scan + 1).otherwise(F.col("mark"))
        rows = rows.withColumn("mark", reached.cast("short"))
        last, counts = counts, written(rows.where((F.col("mark") > REACHED) | (F.col("mark") + shards - 1 > scan)))
        # nothing reads these again: what they led to is written
        if last is not None:
            discard(last)
        if maps is not None:
            maps.broadcast.destroy()
        scan += 1
        taken = _taken(counts, max_words - 1, size_log2)

    # the words of each phrase: from the first part that has it
    spelled, left = None, counts.where(F.col("mark") > REACHED).select("key", "c")
    for rows in [(F.col("shard") == 0) & (F.col("part") == 0), (F.col("shard") == 0) & (F.col("part") > 0), *[F.col("shard") == s for s in range(1, shards)]]:
        wanted = _taken(left.withColumn("mark", F.lit(REACHED + 1)), max_words, size_log2)
        sent = Sent(spark, wanted)
        own = dealt.where(rows).select("lang", "codes").mapInArrow(_speller(sent, _lengths(wanted[0]), size_log2), "key long, lang string, codes array<long>")
        own = written(left.join(own.groupBy("key").agg(F.min(F.struct("lang", "codes")).alias("p")), "key").select("key", "c", "p.lang", "p.codes"))
        sent.broadcast.destroy()
        spelled = own if spelled is None else spelled.unionByName(own)
        left = written(left.join(own.select("key"), "key", "left_anti"))
        if left.isEmpty():
            break
    spelled = spelled.withColumn("words", F.size("codes"))
    names, left = None, written(spelled.where("words = 1").select(F.col("codes")[0].alias("code")).distinct())
    for rows in (F.col("task") % NAMED_FIRST == 0, F.col("task") % NAMED_FIRST > 0):
        sent = Sent(spark, _taken(left.select(F.col("code").alias("key"), F.lit(REACHED + 1).alias("mark")), 8, size_log2))
        new = dealt.where(rows).select("new", "low")
        new = new.coalesce(-(-new.rdd.getNumPartitions() // NAMED_PARTITIONS) or 1)
        own = new.mapInArrow(_namer(sent, size_log2), "code long, word binary").groupBy("code").agg(F.min("word").alias("word"))
        own = written(own.join(left, "code", "left_semi"))
        sent.broadcast.destroy()
        names = own if names is None else names.unionByName(own)
        left = left.join(own, "code", "left_anti")
    parts = spelled.select("key", "lang", "words", "c", F.posexplode("codes").alias("at", "code")).join(names, "code")
    phrases = parts.groupBy("key", "lang", "words", "c").agg(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("w"))
    phrases = phrases.select("lang", F.array_join(F.col("w.word"), " ").alias("phrase"), "words", F.col("c").alias("n"))

    total = dealt.groupBy("lang").agg(F.sum("size").alias("n")).where("n > 0")
    return written(phrases.unionByName(total.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("words"), "n")))


def _speller(sent: Sent, lengths: list[int], size_log2: int):
    """The phrases of a task, of some lengths, whose keys have a place, once each, as word hashes."""
    def spell(batches):
        places, seen = sent.built(_places, size_log2), np.zeros(0, np.uint64)
        for lang, codes in runs(batches):
            grams = Grams(codes, lang)
            for n in lengths:
                keys = grams.keys(n)
                at = np.flatnonzero(grams.valid(n) & (since(places, keys) > 0))
                own, first = np.unique(keys[at], return_index=True)
                new = ~np.isin(own, seen, assume_unique=True)
                own, first = own[new], at[first[new]]
                seen = np.concatenate([seen, own])
                for s in range(0, len(own), 1 << 14):
                    starts = first[s:s + (1 << 14)]
                    flat = codes[starts[:, None] + np.arange(n)].view(np.int64).ravel()
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n, np.int32)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([pa.array(own[s:s + (1 << 14)].view(np.int64)), pa.array([lang] * len(starts)), lists], names=["key", "lang", "codes"])
    return spell


def _namer(sent: Sent, size_log2: int):
    """The words of a task whose hashes have a place, once each."""
    def name(batches):
        places, done = sent.built(_places, size_log2), set()
        for b in batches:
            for new, low in zip(b.column("new"), b.column("low")):
                keep = np.flatnonzero(since(places, np.frombuffer(low.as_buffer(), np.uint32).astype(np.uint64)) > 0).tolist()
                if keep:
                    new = new.as_buffer().to_pybytes().split(b" ")
                    found = list({new[i] for i in keep} - done)
                    done.update(found)
                    yield pa.RecordBatch.from_arrays([pa.array(codes_of(found).view(np.int64)), pa.array(found, pa.binary())], names=["code", "word"])
    return name


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100, top: int = 2000,
                 shards: int = 3, size_log2: int = 22) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by their weakest cut.

    Candidates are phrases of 2 to ``max_words`` words (at most 7) with ``min_count``
    occurrences ``a`` or more in their language, inside pieces; ``n`` is the
    language's number of word occurrences.  A cut after the first k words has
    floor(1000 * a * n / (l * r)), ``l`` and ``r`` being the occurrences of its
    parts; the lowest is the score, of equal ones that of the smallest k.
    Candidates inside a longer candidate with as many occurrences are left out.
    Ranked by score, then ``a``, then phrase by bytes.  A null text is an empty
    one, a null language ``und``; repeated rows count each; an empty table, or
    one without a frequent phrase, gives no rows.
    """
    if not 2 <= max_words <= 7:
        raise ValueError("phrases have 2 to 7 words")
    found = frequent_phrases(docs, text_col, lang_col, max_words, min_count, shards, size_log2)
    count = found.select("lang", "phrase", "words", F.col("n").alias("a"))
    long = count.where("words > 1")
    # as occurrences never grow with length, the candidates one word longer decide
    parts = F.split("phrase", " ")
    inside = long.where("words > 2").select("lang", "a", parts.alias("w"), F.col("words").alias("k"))
    inside = inside.select("lang", "a", F.explode(F.array(F.array_join(F.slice("w", F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("k") - 1), " "))).alias("phrase"))
    kept = long.join(inside.distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = kept.withColumn("w", parts).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    cuts = cuts.join(count.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(count.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    total = count.where("words = 0").select("lang", F.col("a").alias("n"))
    cuts = cuts.join(total, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    over = (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * wide("n")).alias("over")
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", "n", over, (wide("l") * wide("r")).alias("under"))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    best = best.select("lang", "phrase", "a", "n", "m.l", "m.r", "m.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
