"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns words into symbols (insult, threat, target, negation,
reported speech, clause end, other) with a weight.  Small transducers for target,
negation, reported speech and the match itself are composed into one table of states
and gains; running it over a document scores matched clauses: an insult counts more
when its clause has a target, less after a negation or in reported speech, and a
threat counts only with a target.  The summed clauses are set against what as many words of
clean text hold by chance: mean and spread of clean evidence per word are learned from the
sample.  A document's evidence is the largest such excess, of the whole document or of one of
its blocks of ``BLOCK`` words, so long clean texts do not add up to a match and a toxic
passage is not lost in a long text.

The grammar's words are a short fixed list plus words and word stems learned from
labelled rows: those far more frequent in toxic documents, chosen so that each toxic
document of the sample is covered several times.  The score is a logistic function of
the evidence, centred where the sample separates best.

Learning uses at most ``sample_rows`` labelled documents per class, drawn by hash; word
counts over the sample are a Spark aggregation, and at most ``candidates`` terms come to
the driver.  Scoring covers every document and whole text.

Edge cases: NULL and empty texts have no evidence and score as such; rows of the sample
with NULL labels are left out; without labelled rows the fixed words decide; a very
long clause is read in one pass with constant state; other columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import Recent, crc_remainder, free_names, quoted, store, text_of

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

# fixed words of the grammar; stems are learned
FIXED = {
    INSULT: "idiot idiots moron morons stupid scum loser losers imbecile dumbass pathetic "
            "worthless disgusting trash clown vermin arschloch schlampe connard salope imbécil "
            "pendejo cabrón",
    THREAT: "kill murder shoot stab strangle umbringen töten tuer matar",
    TARGET: "you your yourself u they them these those he she him her du dich dein euch sie "
            "tu toi vous ton ellos usted ustedes vosotros",
    NEGATION: "not no never neither nor isn't aren't wasn't don't nicht kein keine nie pas "
              "jamais nunca jamás",
    REPORT: "said says say claimed claims wrote writes quoted quotes reported according sagte "
            "sagt schrieb dit écrit dijo dice escribió",
}
FIXED_WEIGHT = 3.0
STEM_SIZES = range(4, 9)
STRIP = ".,;:!?\"'()[]{}<>*#$%&|-–—«»“”„"
CLAUSE_END = (".", "!", "?", ";", ":")
BLOCK = 128


# --- transducers ----------------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """States 0..n-1; ``step(state, symbol)`` gives the next state, ``gain`` a factor."""

    states: int
    step: dict[tuple[int, int], int]
    gain: dict[tuple[int, int], float] = field(default_factory=dict)


def _automaton(states: int, moves: dict, gains: dict) -> Transducer:
    """Missing moves stay; a clause end returns to the start."""
    step = {(q, s): moves.get((q, s), 0 if s == END else q)
            for q in range(states) for s in range(7)}
    return Transducer(states, step, gains)


# a target seen in the clause raises insults and lets threats count
TARGETS = _automaton(2, {(0, TARGET): 1}, {
    (1, INSULT): 1.5, (0, THREAT): 0.0, (1, THREAT): 1.5})
# a negation weakens what follows within three words
NEGATIONS = _automaton(4, {
    **{(q, NEGATION): 3 for q in range(4)},
    **{(q, s): q - 1 for q in range(1, 4)
       for s in (OTHER, INSULT, THREAT, TARGET, REPORT)}},
    {(q, s): 0.4 for q in range(1, 4) for s in (INSULT, THREAT)})
# reported speech in the clause weakens it
REPORTS = _automaton(2, {(0, REPORT): 1}, {(1, INSULT): 0.6, (1, THREAT): 0.5})
# repeated matches of a clause add less and less
MATCHES = _automaton(3, {
    (q, s): min(q + 1, 2) for q in range(3) for s in (INSULT, THREAT)},
    {(1, INSULT): 0.7, (2, INSULT): 0.5, (1, THREAT): 0.7, (2, THREAT): 0.5})


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list[float]]]:
    """The product: next state and gain by state and symbol."""
    states = list(product(*(range(p.states) for p in parts)))
    index = {q: i for i, q in enumerate(states)}
    step = [[index[tuple(p.step[q, s] for p, q in zip(parts, qs))] for s in range(7)]
            for qs in states]
    gain = [[math.prod(p.gain.get((q, s), 1.0) for p, q in zip(parts, qs))
             if s in (INSULT, THREAT) else 0.0 for s in range(7)] for qs in states]
    return step, gain


STEP, GAIN = compose(TARGETS, NEGATIONS, REPORTS, MATCHES)


@dataclass(frozen=True)
class Grammar:
    """Learned insults, whole words and stems, and where the score turns."""

    words: dict[str, float]
    stems: dict[str, float]
    centre: float = math.log1p(1.5)
    slope: float = 4.0
    rate: float = 0.0    # clean evidence per word
    spread: float = 0.0  # its variance per word

    def excess(self, evidence: float, words: int) -> float:
        return max(0.0, evidence - self.rate * words) / math.sqrt(1 + self.spread * words)


class Reader:
    """Runs the composed transducer over texts."""

    def __init__(self, grammar: Grammar, cache_entries: int = 150_000):
        self.fixed = {w: s for s, words in FIXED.items() for w in words.split()}
        self.grammar = grammar
        self.symbol = Recent(self._symbol, cache_entries)

    def _symbol(self, token: str) -> tuple[int, float, bool]:
        """Symbol, weight, whether a clause ends after the token."""
        ends = token.endswith(CLAUSE_END)
        word = token.strip(STRIP)
        weight = self.grammar.words.get(word, 0.0)
        for n in STEM_SIZES:
            if len(word) < n:
                break
            weight = max(weight, self.grammar.stems.get(word[:n], 0.0))
        if weight:
            return INSULT, weight, ends
        symbol = self.fixed.get(word, OTHER)
        return symbol, FIXED_WEIGHT if symbol in (INSULT, THREAT) else 0.0, ends

    def evidence(self, text: str) -> float:
        """The largest excess of matched clauses, of the text or of one block of it."""
        total, words, best = 0.0, 0, 0.0
        held, size = 0.0, 0
        for line in text.lower().split("\n"):
            symbols = list(map(self.symbol.__getitem__, line.split()))
            matched = any([s[1] for s in symbols])
            for n, gain in self._clauses(symbols) if matched else [(len(symbols), 0.0)]:
                total, words = total + gain, words + n
                if size + n > BLOCK:
                    best = max(best, self.grammar.excess(held, size))
                    held, size = 0.0, 0
                held, size = held + gain, size + n
        self.symbol.age()
        return max(best, self.grammar.excess(held, size), self.grammar.excess(total, words))

    def _clauses(self, symbols: list[tuple[int, float, bool]]) -> Iterator[tuple[int, float]]:
        """Words and gain of each clause.  A target may follow its insult, so clauses with
        one start in its state."""
        start = 0
        for stop, (_, _, ends) in enumerate(symbols, 1):
            if not ends and stop < len(symbols):
                continue
            clause = symbols[start:stop]
            start = stop
            state, total = 0, 0.0
            if any(s[0] == TARGET for s in clause):
                state = STEP[state][TARGET]
            for symbol, weight, _ in clause:
                total += weight * GAIN[state][symbol]
                state = STEP[state][symbol]
            yield len(clause), total


def evidence(text: Column, grammar: Grammar) -> Column:
    @F.arrow_udf("double")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(grammar)
        for batch in batches:
            yield pa.array([reader.evidence(t or "") for t in batch.to_pylist()], pa.float64())

    return read(text)


def score_of(evidence: Column, grammar: Grammar) -> Column:
    turn = F.lit(grammar.slope) * (F.log1p(evidence) - F.lit(grammar.centre))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-turn))


# --- learning -------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str,
                    modulus: int, held_out: int, sample_rows: int) -> DataFrame:
    """``_id``, ``_y``, ``_text`` of at most ``sample_rows`` training rows per class."""
    rows = labels.where(crc_remainder(key, modulus) != held_out).select(
        F.col(quoted(key)).alias("_id"), F.col(label).cast("int").alias("_y"))
    drawn = None
    for y in (0, 1):
        some = rows.where(F.col("_y") == y).dropDuplicates(["_id"]).orderBy(
            F.xxhash64("_id"), "_id").limit(sample_rows)
        drawn = some if drawn is None else drawn.unionByName(some)
    body = docs.select(F.col(quoted(key)).alias("_doc"), text_of(text).alias("_text"))
    return body.join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).select(
        "_id", "_y", "_text")


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", modulus: int = 5, held_out: int = 0,
          sample_rows: int = 3000, candidates: int = 4000) -> Grammar:
    """Learn words, stems and the turning point from labelled training rows."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, key, text, modulus, held_out, sample_rows)
    sample = store(sample.dropDuplicates(["_text"]), "labelled-sample")
    word = F.explode(F.split(F.lower("_text"), r"[^\p{L}'’]+", -1))
    words = sample.select("_id", "_y", word.alias("_w")).where(F.length("_w") >= 3).groupBy(
        "_id", "_y", "_w").agg(F.count(F.lit(1)).alias("_n"))
    stem = F.explode(F.concat(
        F.array(F.concat(F.lit("w:"), F.col("_w"))),
        F.transform(F.filter(F.array(*map(F.lit, STEM_SIZES)), lambda n: n <= F.length("_w")),
                    lambda n: F.concat(F.lit("s:"), F.substring(F.col("_w"), F.lit(1), n)))))
    terms = words.select("_id", "_y", "_n", stem.alias("_t")).groupBy("_id", "_y", "_t").agg(
        F.sum("_n").alias("_n"))
    counted = terms.groupBy("_t").agg(
        F.sum("_y").alias("pos"), F.sum(F.col("_n") * F.col("_y")).alias("toxic"),
        F.sum(F.col("_n") * (1 - F.col("_y"))).alias("clean"))
    size = {r["_y"]: r["n"] for r in words.groupBy("_y").agg(F.sum("_n").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Grammar({}, {})
    # how much more often the term occurs among the words of toxic documents
    weight = (F.log((F.col("toxic") + 0.5) / (n1 + 1))
              - F.log((F.col("clean") + 0.5) / (n0 + 1)))
    best = counted.withColumn("weight", weight).where(
        # a stem stands for words that the sample does not show: it needs more support
        (F.col("pos") >= F.when(F.col("_t").startswith("s:"), 6).otherwise(3))
        & (F.col("weight") >= 1.5)).orderBy(
        F.desc("pos"), F.desc("weight"), "_t").limit(candidates)
    chosen = best.collect()
    found = terms.where("_y = 1").join(
        F.broadcast(spark.createDataFrame([(r["_t"],) for r in chosen] or [("",)], "_t string")),
        "_t").select("_t", "_id").collect()
    grammar = _cover({r["_t"]: r["weight"] for r in chosen}, found)
    clean = sample.where("_y = 0").select(
        evidence(F.col("_text"), grammar).alias("e"),
        F.size(F.split(F.trim("_text"), r"\s+", -1)).alias("w")).collect()
    grammar = _with_length(grammar, [(r["e"], r["w"]) for r in clean])
    seen = sample.select(evidence(F.col("_text"), grammar).alias("e"), "_y").collect()
    return _centred(grammar, [(math.log1p(r["e"]), r["_y"]) for r in seen])


def _cover(weights: dict[str, float], found: list, times: int = 3, least: int = 3) -> Grammar:
    """Take the term that covers most documents not yet covered ``times`` times, again and
    again; a document's own rare words never cover ``least`` documents."""
    holders: dict[str, set] = defaultdict(set)
    for r in found:
        holders[r["_t"]].add(r["_id"])
    covered: Counter = Counter()
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    while holders:
        # of equally good terms the longest: it says most about the word
        term = max(holders, key=lambda t: (
            sum(covered[d] < times for d in holders[t]) * min(weights[t], 4.0), len(t), t))
        if sum(covered[d] < times for d in holders[term]) < least:
            break
        covered.update(holders.pop(term))
        kind, text = term.split(":", 1)
        (words if kind == "w" else stems)[text] = min(weights[term], 6.0)
    return Grammar(words, stems)


def _with_length(grammar: Grammar, clean: list[tuple[float, int]]) -> Grammar:
    """Mean and variance per word of the evidence in clean documents."""
    words = max(1, sum(w for _, w in clean))
    rate = sum(e for e, _ in clean) / words
    return replace(grammar, rate=rate, spread=sum((e - rate * w) ** 2 for e, w in clean) / words)


def _centred(grammar: Grammar, points: list[tuple[float, int]]) -> Grammar:
    """Put the turn where balanced accuracy on the sample is best."""
    points = sorted(points)
    n1 = sum(y for _, y in points)
    n0 = len(points) - n1
    below1 = below0 = 0
    best, centre = -1.0, grammar.centre
    for (x, y), (x_next, _) in zip(points, points[1:]):
        below1, below0 = below1 + y, below0 + 1 - y
        gain = below0 / n0 + 1 - below1 / n1
        if x_next > x and gain > best:
            best, centre = gain, (x + x_next) / 2
    return replace(grammar, centre=centre)


# --- use ------------------------------------------------------------------------------

def score_toxicity(docs: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``."""
    seen, score, predicted = free_names(docs, "_evidence", "score", "predicted")
    scored = docs.withColumn(seen, evidence(text_of(text), grammar))
    scored = scored.withColumn(score, score_of(F.col(seen), grammar)).drop(seen)
    return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` without those predicted toxic, columns unchanged."""
    grammar = learn(docs, labels, key, text)
    scored = score_toxicity(docs, grammar, text)
    return scored.where(F.col(quoted(scored.columns[-1])) == 0).select(
        *(F.col(quoted(c)) for c in docs.columns))
