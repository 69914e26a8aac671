"""Toxicity evidence and the quality network against plain definitions, word by word."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import quality_mil, toxicity

# --- toxicity: what each word of a clause counts, by rules and not by states -----------------

KINDS = {w: k for k, ws in (
    ("insult", toxicity.FIXED[toxicity.INSULT]), ("threat", toxicity.FIXED[toxicity.THREAT]),
    ("target", toxicity.FIXED[toxicity.TARGET]), ("not", toxicity.FIXED[toxicity.NEGATION]),
    ("said", toxicity.FIXED[toxicity.REPORT])) for w in ws.split()}


def kind_and_weight(token, words, stems):
    word = token.strip(toxicity.STRIP)
    learned = max([words.get(word, 0.0)] + [
        stems.get(word[:n], 0.0) for n in range(4, 9) if len(word) >= n])
    if learned:
        return "insult", learned
    kind = KINDS.get(word, "other")
    return kind, 3.0 if kind in ("insult", "threat") else 0.0


def clause_value(clause):
    """clause: (kind, weight) of its words."""
    total, matches = 0.0, 0
    target = any(k == "target" for k, _ in clause)
    for i, (kind, weight) in enumerate(clause):
        if kind not in ("insult", "threat"):
            continue
        factor = (1.5 if target else 1.0) if kind == "insult" else (1.5 if target else 0.0)
        if any(k == "not" for k, _ in clause[max(0, i - 3):i]):
            factor *= 0.4
        if any(k == "said" for k, _ in clause[:i]):
            factor *= 0.6 if kind == "insult" else 0.5
        total += weight * factor * (1.0, 0.7, 0.5)[min(matches, 2)]
        matches += 1
    return total


def plain_evidence(text, words, stems, rate, spread):
    units = []
    for line in text.lower().split("\n"):
        tokens = line.split()
        seen = [kind_and_weight(t, words, stems) for t in tokens]
        if not any(w for _, w in seen):
            units.append((len(tokens), 0.0))
            continue
        ends = [i + 1 for i, t in enumerate(tokens) if t[-1] in ".!?;:"]
        for a, b in zip([0, *ends], [*ends, len(tokens)]):
            if b > a:
                units.append((b - a, clause_value(seen[a:b])))

    def excess(some):
        n, e = sum(n for n, _ in some), sum(e for _, e in some)
        return max(0.0, e - rate * n) / math.sqrt(1 + spread * n)

    blocks, block = [], []
    for unit in units:
        if sum(n for n, _ in block) + unit[0] > 128:
            blocks.append(block)
            block = []
        block.append(unit)
    return max(map(excess, [*blocks, block, units]))


def test_evidence_is_that_of_the_rules(spark):
    rng = random.Random(4)
    words, stems = {"grumble": 2.5, "blarg": 4.0}, {"zorp": 1.75, "snazzl": 3.5}
    lexicon = [*list(KINDS)[::3], "grumble", "blarg!", "zorping", "snazzling", "Fine", "day,",
               "house", "walks.", "then;", "(kill)", "YOU", "not", "said:", "why?", "…", "a"]
    texts = ["", "\n\n", "you idiot", "idiot", "kill", "not an idiot", "he said you idiot!"]
    for _ in range(300):
        size = rng.choice([3, 20, 200, 900])
        plenty = rng.random() < .5
        texts.append("".join(rng.choice(lexicon if plenty or rng.random() < .1 else ["plain", "word"])
                             + rng.choice([" ", " ", "  ", "\n"]) for _ in range(size)))
    for rate, spread in ((0.0, 0.0), (0.05, 0.02)):
        grammar = toxicity.Grammar(words, stems, rate=rate, spread=spread)
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        for r in df.select("t", toxicity.evidence(F.col("t"), grammar).alias("e")).collect():
            want = plain_evidence(r["t"], words, stems, rate, spread)
            assert r["e"] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_the_composed_table_is_the_product():
    """Every state and symbol of the composed table, against its four parts."""
    parts = (toxicity.TARGETS, toxicity.NEGATIONS, toxicity.REPORTS, toxicity.MATCHES)
    sizes = [p.states for p in parts]

    def number(qs):
        out = 0
        for q, n in zip(qs, sizes):
            out = out * n + q
        return out

    for qs in np.ndindex(*sizes):
        for s in range(7):
            assert toxicity.STEP[number(qs)][s] == number(
                [p.step[q, s] for p, q in zip(parts, qs)])
            want = math.prod(p.gain.get((q, s), 1.0) for p, q in zip(parts, qs)) \
                if s in (toxicity.INSULT, toxicity.THREAT) else 0.0
            assert toxicity.GAIN[number(qs)][s] == want


# --- quality: features passage by passage, forward pass value by value -----------------------

CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789",
           bytes(range(128, 256)), b"\n", b".", b",", b"!", b"?", b"|", b"<", b"@",
           b"#$%&*~^_=+", b"()[]{}/\\:;'\"-"]


def plain_features(text):
    raw = text.encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    if not spans:
        return [[0.0] * (len(CLASSES) + 11)]
    out = []
    for at in range(0, len(spans), 64):
        part = spans[at:at + 64]
        words, n = [raw[a:b] for a, b in part], len(part)
        body = raw[part[0][0]:part[-1][1]]
        low = [w.lower() if w.isascii() else bytes(
            c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
        upper, letter = CLASSES[0], CLASSES[0] + CLASSES[1] + CLASSES[3]
        # the byte after a word of one byte is not a letter of its own
        out.append([sum(c in k for c in body) / len(body) for k in CLASSES] + [
            math.log1p(n), sum(map(len, words)) / n / 10,
            sum(len(w) <= 3 for w in words) / n, sum(len(w) >= 12 for w in words) / n,
            sum(a == b for a, b in zip(low, low[1:])) / n, len(set(low)) / n,
            sum(w[0] in upper for w in words) / n,
            sum(w[0] in upper and (len(w) == 1 or w[1] in upper) for w in words) / n,
            sum(w[-1] not in letter for w in words) / n, sum(len(w) == 1 for w in words) / n,
            sum(c in b" \t\n\x0b\x0c\r" for c in body) / len(body)])
    return out


def plain_score(bag, net):
    def sigmoid(v):
        return 1 / (1 + math.exp(-max(-30, min(30, v))))

    def times(x, m):
        return [sum(a * m[i][j] for i, a in enumerate(x)) for j in range(len(m[0]))]

    hs, es = [], []
    for x in bag:
        h = [math.tanh(v) for v in times(
            [(a - s) * k for a, s, k in zip(x, net.shift, net.scale)], net.W)]
        gate = [math.tanh(t) * sigmoid(u) for t, u in zip(times(h, net.V), times(h, net.U))]
        hs.append(h)
        es.append(sum(w * g for w, g in zip(net.w, gate)))
    weights = [math.exp(e - max(es)) for e in es]
    z = [sum(a * h[j] for a, h in zip(weights, hs)) / sum(weights) for j in range(len(net.c))]
    return sigmoid(sum(c * v for c, v in zip(net.c, z)) + net.b[0])


def test_scores_are_those_of_a_plain_forward_pass(spark):
    rng = random.Random(9)
    tokens = ["The", "quick", "FOX", "a", "I", "it's", "12,5", "<p>", "über", "漢字", "word", "Word",
              "end.", "why?!", "a|b", "x@y.z", "#tag", "supercalifragilistic", "é", "no"]
    texts = ["", "  \n", "one", "A", "é", "last!"] + [
        "".join(rng.choice(tokens) + rng.choice([" ", " ", "\n", "\t "])
                for _ in range(rng.choice([2, 63, 64, 65, 130, 700]))) for _ in range(60)]
    bags = [np.array(plain_features(t), np.float32) for t in texts]
    labels = np.array([i % 2 for i in range(len(texts))], float)
    net = quality_mil.train_network(bags, labels, epochs=3)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select(
        "i", quality_mil.quality(F.col("t"), net).alias("s")).collect()}
    for i, bag in enumerate(bags):
        assert got[i] == pytest.approx(plain_score(bag.tolist(), net), abs=2e-4)
