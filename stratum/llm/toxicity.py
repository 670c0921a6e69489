"""Toxicity by misspelling-tolerant lexicon matches in their context.

The lexicon is mined from labelled documents: words and stems (word beginnings)
that are common in toxic documents and rare in others, by document counts over
all learning rows. Its trie and the Levenshtein automata over it run as one
automaton, whose states are made as words lead to them; reading a word's letters
finds every entry within reach. Near words that clean documents use as often
are ordinary words, not misspellings, and are set aside.

A match counts by its context window: quotation marks around it or a reporting
word just before it make it a mention rather than abuse. Logistic regression
turns the sums into a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import bounded, slices, stored

STEM_SIZES = range(4, 8)   # letters of a stem
CHANCE = 0.05              # bound on the chance that any term is an entry by its counts' luck
LIFT = 10.0                # an entry is so many times as common in toxic documents as in others, of which UNSEEN more are
UNSEEN = 3                 # thought to hold it than were seen (where none was, 3 is the 95 % bound)
HELD_TERMS = 200_000       # terms that tasks hold to count them in the other documents; of more, all are counted
FIT_ROWS = 40_000          # learning rows that the regression is fitted on at most, chosen by hash
NEAR = 0.7                 # what a misspelled match counts of an exact one
WINDOW = 60                # characters of context before and after a match
MEMO_ENTRIES = 300_000
STATES = 100_000           # states of the automaton that a worker keeps before it starts afresh

# Marks and words that introduce quoted speech.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset("said says say wrote called quote quoted dit disait écrit cité sagte sagt schrieb nannte zitat dijo dice escribió llamó cita".split())
_WORDS = regex.compile(r"[^\W_]+")


def edits_allowed(entry: str, stem: bool) -> int:
    """Short entries match exactly: too many ordinary words are near them."""
    n = len(entry) - 2 * stem
    return 2 if n >= 9 else 1 if n >= 5 else 0


class Lexicon:
    """Entries (text, is a stem) in a trie, and Levenshtein automata of up to two edits over it.

    Trie and automata are run as one automaton: a state says with how few edits
    each trie node can have been reached by the letters read, and which stem was
    the nearest so far. States are made when a word first leads to them and
    kept, so a word costs one look-up a letter; most words die after a few.
    """

    def __init__(self, entries: list[tuple[str, bool]], ordinary: frozenset[str] = frozenset()) -> None:
        self.entries, self.ordinary = entries, ordinary
        self.below: list[dict[str, int]] = [{}]          # of each node
        self.most = [0]                                  # edits that entries at the node or below allow
        self.ends: list[list[tuple[int, bool, int]]] = [[]]
        for i, (text, stem) in enumerate(entries):
            node, allowed = 0, edits_allowed(text, stem)
            self.most[0] = max(self.most[0], allowed)
            for letter in text:
                if letter not in self.below[node]:
                    self.below[node][letter] = len(self.below)
                    self.below.append({})
                    self.most.append(0)
                    self.ends.append([])
                node = self.below[node][letter]
                self.most[node] = max(self.most[node], allowed)
            self.ends[node].append((allowed, stem, i))
        self.memo: dict[str, tuple[int, int]] = {}
        self.misses: set[str] = set()
        self._forget()

    def _forget(self) -> None:
        """Start the automaton afresh, with the state before any letter."""
        self.known: dict[tuple, int] = {}
        self.states: list[dict[int, int]] = []           # node -> edits
        self.steps: list[dict[str, int]] = []            # letter -> state
        self.so_far: list[tuple[int, int] | None] = []   # nearest stem read so far
        self.at_end: list[tuple[int, int] | None] = []   # nearest entry if the word ends here
        self._state({0: 0}, None)

    def _state(self, reached: dict[int, int], best: tuple[int, int] | None) -> int:
        """The state of these nodes, and of those below them that letters left out of the word lead to."""
        open_ = list(reached)
        while open_:
            node = open_.pop()
            edits = reached[node] + 1
            for child in self.below[node].values():
                if edits <= self.most[child] and edits < reached.get(child, 9):
                    reached[child] = edits
                    open_.append(child)
        end = None
        for node, edits in reached.items():
            for allowed, stem, i in self.ends[node]:
                if edits <= allowed:
                    if stem:
                        best = min(best or (9, 0), (edits, i))
                    else:
                        end = min(end or (9, 0), (edits, i))
        key = (frozenset(reached.items()), best)
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(reached)
            self.steps.append({})
            self.so_far.append(best)
            self.at_end.append(min(x for x in (best, end) if x) if best or end else None)
        return self.known[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, edits in self.states[state].items():
            if edits < self.most[node]:  # a letter too many
                reached[node] = min(reached.get(node, 9), edits + 1)
            for other, child in self.below[node].items():
                now = edits + (other != letter)
                if now <= self.most[child] and now < reached.get(child, 9):
                    reached[child] = now
        return self._state(reached, self.so_far[state])

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the nearest entry, or None."""
        if len(self.states) > STATES:
            self._forget()
        state, steps = 0, self.steps
        for letter in word:
            after = steps[state].get(letter)
            if after is None:
                after = steps[state][letter] = self._step(state, letter)
            state = after
            if not self.states[state]:  # no entry can be reached any more
                return self.so_far[state]
        return self.at_end[state]

    def match(self, word: str) -> tuple[int, int] | None:
        """`find`, but for ordinary words that are near an entry; remembered."""
        if word in self.misses:
            return None
        found = self.memo.get(word)
        if found is None:
            found = self.find(word)
            if found is None or found[0] and word in self.ordinary:
                if len(self.misses) >= MEMO_ENTRIES:
                    self.misses.clear()
                self.misses.add(word)
                return None
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[word] = found
        return found

    def evidence(self, text: str) -> list[float]:
        """Sums over matches: abuse, mentions, and abuse per 100 words (logarithms of 1 + sum)."""
        low = text.lower()
        words = _WORDS.findall(low)
        hits = {w: m for w in set(words) - self.misses if (m := self.match(w))}
        abuse = mention = 0.0
        if hits:
            recent: list[str] = []
            for found in _WORDS.finditer(low):
                word = found.group()
                if word in hits:
                    before, after = low[max(0, found.start() - WINDOW):found.start()], low[found.end():found.end() + WINDOW]
                    marked = sum(map(before.count, QUOTES)) % 2 == 1 and any(q in after for q in QUOTES)
                    spoken = 0.5 * marked + 0.5 * any(w in REPORTING for w in recent[-6:])
                    worth = NEAR ** hits[word][0]
                    abuse += worth * (1 - spoken)
                    mention += worth * spoken
                recent.append(word)
                if len(recent) > 64:
                    del recent[:-6]
        return [math.log1p(abuse), math.log1p(mention), math.log1p(100 * abuse / max(1, len(words)))]


def _terms(text: str) -> tuple[set[str], set[str]]:
    """Words and stems of a text."""
    words = set(_WORDS.findall(text.lower()))
    stems: set[str] = set()
    for k in STEM_SIZES:
        stems.update([w[:k] for w in words if len(w) >= k])
    return words, stems


def _counted(rows: DataFrame, terms_of, schema: str = "term string, stem boolean, n bigint") -> DataFrame:
    """Document counts of what `terms_of` finds in each text, added up per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stems = Counter(), Counter()
        for whole in batches:
            for batch in slices(whole, "__text"):
                for text in batch.column("__text").to_pylist():
                    found = terms_of(text or "")
                    words.update(found[0])
                    stems.update(found[1])
                if len(words) + len(stems) > 200_000:
                    yield made(words, stems)
                    words.clear()
                    stems.clear()
        yield made(words, stems)

    def made(words: Counter, stems: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([*words, *stems], pa.string()), pa.array([False] * len(words) + [True] * len(stems), pa.bool_()),
                                           pa.array([*words.values(), *stems.values()], pa.int64())], ["term", "stem", "n"])

    return rows.select("__text").mapInArrow(run, schema).groupBy("term", "stem").agg(F.sum("n").alias("n"))


def mine(rows: DataFrame) -> Lexicon:
    """The lexicon of learning rows (__text, __label)."""
    total = dict(rows.groupBy("__label").count().collect())
    toxic, clean = total.get(1, 0), total.get(0, 0)
    seen = stored(_counted(rows.filter("__label = 1"), _terms), "toxic-terms")
    # Chernoff's bound on n of n + m documents being toxic by luck is exp(-surprise); all terms seen are tested.
    share, least = toxic / (toxic + clean), math.log(max(1, seen.count()) / CHANCE)
    common = seen.filter(F.col("n") >= max(2, least / -math.log(share)))
    others = rows.filter("__label = 0")
    if common.count() <= HELD_TERMS:
        listed = common.collect()
        held_terms = rows.sparkSession.sparkContext.broadcast(tuple(frozenset(r.term for r in listed if r.stem == stem) for stem in (False, True)))

        def held_of(text: str) -> tuple[set[str], set[str]]:
            words, stems = _terms(text)
            return words & held_terms.value[0], stems & held_terms.value[1]
        elsewhere = _counted(others, held_of)
    else:
        elsewhere = _counted(others, _terms)
    n, m = F.col("n"), F.coalesce("m", F.lit(0))
    lift = ((n + 0.5) / (toxic + 1)) / ((m + UNSEEN) / (clean + UNSEEN))
    surprise = n * F.log(n / (n + m) / share) + F.when(m > 0, m * F.log(m / (n + m) / (1 - share))).otherwise(0.0)
    chosen = (common.join(elsewhere.withColumnRenamed("n", "m"), ["term", "stem"], "left").withColumn("lift", lift)
              .filter((F.col("lift") >= LIFT) & (surprise >= least)).collect())
    scored = [(r.n / toxic * math.log(r.lift), len(r.term) + (not r.stem), r.term, r.stem) for r in chosen]
    scored.sort(key=lambda x: (-x[0], -x[1], x[2]))
    entries: list[tuple[str, bool]] = []
    taken: dict[bool, set[str]] = {True: set(), False: set()}
    begun: set[str] = set()  # beginnings of entries
    for _, _, term, stem in scored:
        starts = [term[:k] for k in range(1, len(term) + 1)]
        if not (taken[True].intersection(starts) or (taken[False].intersection(starts) or term in begun if stem else term in taken[False])):
            entries.append((term, stem))
            taken[stem].add(term)
            begun.update(starts)
    lexicon = Lexicon(entries)
    if not entries:
        return lexicon
    held = rows.sparkSession.sparkContext.broadcast(entries)

    def near(text: str) -> tuple[set[str], set[str]]:
        key = tuple(held.value)
        own = _LEXICONS.get(key) or _LEXICONS.setdefault(key, Lexicon(held.value))
        return {w for w in set(_WORDS.findall(text.lower())) if (m := own.match(w)) and m[0]}, set()

    # At most the strings within two edits of the entries.
    in_clean = {r.term: r.n for r in _counted(rows.filter("__label = 0"), near).collect()}
    in_toxic = {r.term: r.n for r in _counted(rows.filter("__label = 1"), near).collect()}
    return Lexicon(entries, frozenset(w for w, n in in_clean.items() if n / max(1, clean) * LIFT >= in_toxic.get(w, 0) / max(1, toxic)))


_LEXICONS: dict[tuple, Lexicon] = {}


def _with_evidence(rows: DataFrame, lexicon: Lexicon, text_col: str) -> DataFrame:
    """Rows of (__row, ...) with __evidence of the text in `__row`."""
    shared = rows.sparkSession.sparkContext.broadcast((lexicon.entries, lexicon.ordinary))
    place = rows.schema["__row"].dataType.names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tuple(shared.value[0]), shared.value[1])
        own = _LEXICONS.get(key) or _LEXICONS.setdefault(key, Lexicon(*shared.value))
        for whole in batches:
            whole = whole.append_column("__text", whole.column("__row").field(place))
            for batch in slices(whole, "__text"):
                found = [own.evidence(t or "") for t in batch.column("__text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names[:-1], "__evidence"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("__evidence", T.ArrayType(T.DoubleType()))]))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", learn=None) -> DataFrame:
    """Every row of `docs` as `__row`, with `__score` (0 to 1) and `__predicted` (1 if score >= 0.5).

    Learns from the labels of rows where the condition `learn` holds (all, if None).
    Only the text enters the score. Null and empty texts score like texts without
    matches. Labels that are null or not 0 or 1 are ignored; of labels repeated for an id the
    largest holds. Without both labels, all rows score the share of label 1 (0
    without any). Rows repeating an id or text are scored alike; the input's columns stay whole inside `__row`.
    """
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
             .filter("__id is not null and __label in (0, 1)").groupBy("__id").agg(F.max("__label").alias("__label")))
    if learn is not None:
        known = known.filter(learn(F.col("__id")))
    known = stored(known, "labels")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = stored(texts.join(bounded(known), "__id"), "labelled")
    n, positive = rows.agg(F.count(F.lit(1)), F.sum("__label")).first()
    all_rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    share = (positive or 0) / n if n else 0.0
    if not 0 < share < 1:
        return all_rows.withColumns({"__score": F.lit(float(share)), "__predicted": F.lit(int(share >= 0.5))})
    lexicon = mine(rows)
    chosen = rows.select("__id").distinct().orderBy(F.xxhash64("__id", F.lit(2)), "__id").limit(FIT_ROWS)
    sample = rows.join(F.broadcast(chosen), "__id").select(F.struct("__text").alias("__row"), F.col("__label").cast("double").alias("__label"))
    fit = stored(_with_evidence(sample, lexicon, "__text").select("__label", "__evidence"), "evidence")
    model = LogisticRegression(featuresCol="x", labelCol="__label", regParam=0.001, maxIter=50, standardization=False).fit(fit.select("__label", array_to_vector("__evidence").alias("x")))
    total = F.lit(float(model.intercept))
    for i, weight in enumerate(np.asarray(model.coefficients).tolist()):
        total = total + F.col("__evidence")[i] * weight
    scored = _with_evidence(all_rows, lexicon, text_col).withColumn("__score", 1 / (1 + F.exp(-total))).drop("__evidence")
    return scored.withColumn("__predicted", (F.col("__score") >= 0.5).cast("int"))
