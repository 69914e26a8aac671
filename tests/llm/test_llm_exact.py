"""Operators against plain definitions, libraries and held-out labels, on small whole tables."""

from __future__ import annotations

import math
import os
import random
import shutil
import subprocess
import sys
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from llm_tables import SF
from pyspark.sql import functions as F

from medallion.llm import (
    chat_format,
    oracle,
    pieces,
    quality_mil,
    queries,
    sharding,
    simhash,
    suffix_tree,
    token_counts,
    toxicity,
)

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
MODEL = queries.model_path()
STRINGS = ["", " ", "  ", "▁", "a ", " a", "▁a", "a▁", " " * 17, " " * 33 + "x", "a" + " " * 20 + "b",
           "\n", "<s>", "</s> <unk>", "<0x0A>", "\x00", "a\r\nb\tc", "é漢字🙂", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def documents(tables):
    return {r["doc_id"]: r["text"] for r in tables("documents").collect()}


def random_texts(n, seed):
    r = random.Random(seed)
    parts = list("ab the  ing\n\t▁é漢🙂\r123.,!*#=") + ["    ", "▁▁", " the", " return", "$$$"]
    return ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("op", ["op4_decontamination", "op8_content_sort", "op10_chat_format"])
def test_query_agrees_with_its_sql(spark, op):
    from oracle_compare import difference, duck
    assert difference(queries.queries()[op](spark, SF), duck(SF), oracle.oracle_sql()[op]) is None


# --- tokens and pieces ------------------------------------------------------------------

def test_token_counts_are_the_library_s(spark, library, documents):
    rows = queries.op1_token_counts(spark, SF).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)


def test_token_counts_of_odd_texts(library):
    counter = token_counts.PieceLengths(MODEL, cache_entries=50)
    texts = STRINGS + random_texts(3000, 1)
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert counter.count(part) == list(map(len, library.encode(part)))


def test_json_tokenizers_count_too(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([("hello <|endoftext|> world",), ("",)], "text string")
    got = [r[0] for r in df.select(token_counts.token_count(F.col("text"), path)).collect()]
    tok = Tokenizer.from_file(path)
    assert got == [len(tok.encode(t[0], add_special_tokens=False)) for t in df.collect()]


def test_pieces_are_the_library_s(spark, library, documents):
    for r in queries.op5_pieces(spark, SF).collect():
        ids = [library.bos_id(), *library.encode(documents[r["doc_id"]] or ""), library.eos_id()]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == brute.sha(library.decode(ids))


def test_pieces_of_odd_texts(library):
    table = pieces.PrefixTable(MODEL, cache_entries=50)
    for text in STRINGS + random_texts(3000, 2):
        ids, back = table.encode(text)
        want = [library.bos_id(), *library.encode(text), library.eos_id()]
        assert np.frombuffer(ids, "<u4").tolist() == want and back == library.decode(want)


def test_one_token_fits_each_prefix(library):
    """The prefix table's choice is what merging pair by pair gives, for every prefix."""
    table = pieces.PrefixTable(MODEL)
    for word in ("▁internationalisation", "▁theatthere", "▁aaaaaaa", "▁Donaudampfschiff"):
        for end in range(1, len(word) + 1):
            assert [table.piece[i] for i in table.tokens(word[:end])] == table.merge(word[:end])


# --- language model ---------------------------------------------------------------------

def test_base_scores_are_exact_and_contexts_help(spark, documents):
    rows = queries.op2_suffix_tree(spark, SF).collect()
    want = brute.unigram(list(documents.items()))
    assert len(rows) == len(documents)
    for r in rows:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (brute.crc(r["doc_id"]) % 7 == 2)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in rows)


def small_model(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    train = F.col("doc_id") < len(texts) - 1
    return {r["doc_id"]: r for r in suffix_tree.score_texts(df, train=train, **options).collect()}


def test_repeated_phrases_are_likelier_in_their_order(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    noise = [" ".join(r.choices(words, k=60)) for _ in range(80)]
    phrase = " ".join(words[:12])
    train = [f"{n} {phrase}" for n in noise]
    shuffled = " ".join(r.sample(words[:12], 12))
    straight = small_model(spark, [*train, phrase], p_min=1e-4)[len(train)]
    mixed = small_model(spark, [*train, shuffled], p_min=1e-4)[len(train)]
    assert straight["base_score"] == pytest.approx(mixed["base_score"])
    assert straight["score"] > mixed["score"] + 5


def test_rounds_and_chunks_do_not_change_scores(spark):
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(40)) for i in range(60)]
    one = small_model(spark, texts, p_min=1e-3)
    many = small_model(spark, texts, p_min=1e-3, round_size=40, chunk_bytes=500, block=200)
    for i, row in one.items():
        assert many[i]["score"] == pytest.approx(row["score"], rel=1e-9)
        assert many[i]["base_score"] == pytest.approx(row["base_score"], rel=1e-9)


def plain_tree(texts, least, depth=3):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    mined = pa.Table.from_batches(list(suffix_tree._mine(iter([batch]), 0, depth + 1, 10 ** 9)))
    mined = mined.to_pandas()
    grams = [np.sort(mined[mined.k == k].gram.to_numpy(np.int64).view(np.uint64))
             for k in range(1, depth + 2)]
    counts = pa.Table.from_batches(list(suffix_tree._count_found(iter([batch]), grams))).to_pandas()
    symbols = int(counts[counts.k == 0].n.iloc[0])
    rows = mined.merge(counts[(counts.k > 0) & (counts.n >= least)], on=["k", "gram"])
    return suffix_tree.build_tree(rows, symbols, depth, 0.75), symbols


def test_scores_are_those_of_the_tree_in_one_place(spark):
    import pyarrow as pa

    from medallion.llm.bytewords import words_of
    r = random.Random(8)
    texts = [" ".join(r.choices("abcdefgh", weights=range(8, 0, -1), k=20)) + " a b c d e f g h"
             for _ in range(150)]
    tree, symbols = plain_tree(texts[:-1], 5)
    assert all(map(len, tree.context))
    known = Counter(w for t in texts[:-1] for w in [*t.split(), None])
    root = suffix_tree.Root(symbols, len(known), sum(n == 1 for n in known.values()),
                            sum(n == 2 for n in known.values()))
    got = small_model(spark, texts, least=5, chunk_bytes=700)
    for i, t in enumerate(texts):
        s = suffix_tree.symbols_of(words_of(pa.array([t])))
        count = np.array([0] + [known[w] for w in [*t.split(), None]])
        want = suffix_tree.log_probabilities(s, root.probability(count), tree)[1:].sum()
        assert got[i]["score"] == pytest.approx(want, rel=1e-9)


def test_contexts_stay_when_the_corpus_grows(spark):
    """A phrase found 40 times is 5e-6 of 8 million symbols; it helps among 10 million too."""
    phrase = "one two three four five six"
    texts = [*[phrase] * 40, *[f"{w} x" for w in phrase.split() * 200], phrase]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").unionByName(
        spark.range(10_000, 10_100).select(F.col("id").alias("doc_id"),
                                           F.repeat(F.lit("x "), 100_000).alias("text")))
    last = F.col("doc_id") == len(texts) - 1
    row = suffix_tree.score_texts(docs, train=~last).where(last).first()
    assert row["train_tokens"] * 5e-6 > 40
    assert row["score"] > row["base_score"] + 8


def test_blocks_ask_for_no_more_than_the_whole():
    """Start marks do not count: a block of short texts reports what reaches the share."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["a", *[""] * 98, "b b"])], ["t"])
    mined = pa.Table.from_batches(list(suffix_tree._mine(iter([batch]), 1 / 60, 1, 10 ** 6)))
    assert len(mined) == 3  # the start, the end and b: 2 of 103 symbols


def test_next_symbol_distributions_sum_to_one():
    """Over all known words, the end and one other symbol, after every history."""
    import pyarrow as pa

    from medallion.llm.bytewords import words_of
    r = random.Random(5)
    texts = [" ".join(r.choices("abcdef", weights=(9, 5, 3, 2, 1, 1), k=30)) + " x y z" * 3
             for _ in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    mined = pa.Table.from_batches(list(suffix_tree._mine(iter([batch]), 1e-3, 3, 10 ** 6)))
    grams = [np.sort(np.array([g for k, g in zip(mined["k"].to_pylist(), mined["gram"].to_pylist())
                               if k == n], np.int64).view(np.uint64)) for n in (1, 2, 3)]
    counts = pa.Table.from_batches(list(suffix_tree._count_found(iter([batch]), grams))).to_pandas()
    symbols = int(counts[counts.k == 0].n.iloc[0])
    rows = mined.to_pandas().merge(counts[counts.k > 0], on=["k", "gram"])
    tree = suffix_tree.build_tree(rows, symbols, 2, 0.75)
    assert len(tree.context[0]) and len(tree.context[1])
    known = Counter(w for t in texts for w in [*t.split(), None])
    root = suffix_tree.Root(sum(known.values()), len(known), 2, 1)
    for history in ("", "x", "x y", "a b", "e"):
        total = 0.0
        for word in [w for w in known if w] + ["other"]:
            s = suffix_tree.symbols_of(words_of(pa.array([f"{history} {word}"])))
            count = np.array([known.get(word, 0)] * len(s.symbol))
            total += 10 ** suffix_tree.log_probabilities(
                s, root.probability(count), tree)[-2]
        s = suffix_tree.symbols_of(words_of(pa.array([history])))
        total += 10 ** suffix_tree.log_probabilities(
            s, root.probability(np.full(len(s.symbol), known[None])), tree)[-1]
        assert total == pytest.approx(1, abs=1e-9)


# --- near copies ------------------------------------------------------------------------

def test_components_are_those_of_all_pairs(spark, documents):
    prints = [(i, brute.fingerprint(t)) for i, t in documents.items()]
    want = brute.components(prints)
    for r in queries.op3_simhash(spark, SF).collect():
        assert r["fingerprint"] == f"{dict(prints)[r['doc_id']]:016x}"
        assert r["component_id"] == want[r["doc_id"]]


def test_anchors_cover_every_pair(spark):
    r = random.Random(6)
    seeds = [r.getrandbits(64) for _ in range(15)] + [0, (1 << 64) - 1]
    near = {s ^ (1 << a) ^ (1 << b) for s in seeds for a in range(0, 64, 3) for b in range(64)}
    values = sorted({*seeds, *r.sample(sorted(near), 700)})
    df = spark.createDataFrame(
        [(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    got = {(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in simhash.links(df).collect()}
    want = {(a, b) for n, a in enumerate(values) for b in values[:n] if (a ^ b).bit_count() <= 2}
    assert {frozenset(p) for p in got} == {frozenset(p) for p in want}
    assert len(got) == len(want)


def test_long_chains_become_one_component(spark):
    edges = spark.range(199).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.unionByName(spark.range(300, 310).select(
        F.lit(300).cast("bigint").alias("a"), (F.col("id") + 1).alias("b")))
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(200)} == {0} and roots[305] == 300


# --- classifiers ------------------------------------------------------------------------

@pytest.mark.parametrize("op,label,modulus,held", [
    ("op6_toxicity", "toxic", 5, 0), ("op7_quality", "quality", 3, 1)])
def test_held_out_labels_are_predicted(spark, op, label, modulus, held):
    sf = SF.replace("0.001", "0.01")
    rows = {r["doc_id"]: r for r in queries.queries()[op](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(r["held_out"] == (brute.crc(i) % modulus == held) for i, r in rows.items())
    seen = [(rows[x["doc_id"]]["predicted"], x[label]) for x in labels
            if rows[x["doc_id"]]["held_out"]]
    assert sum(p == y for p, y in seen) / len(seen) > 0.9


def test_clauses_are_scored_not_words():
    reader = toxicity.Reader(toxicity.Grammar({"idiot": 3.0}, {"blockh": 2.0}))
    plain, target = reader.evidence("what an idiot."), reader.evidence("you are an idiot.")
    assert 0 < reader.evidence("you are not an idiot.") < plain < target
    assert reader.evidence("he said you are an idiot") < target
    assert reader.evidence("idiot. you went home") < target
    assert reader.evidence("blockheads everywhere") > 0
    assert reader.evidence("kill the process") == 0 < reader.evidence("i will kill you")
    assert reader.evidence("") == 0


def test_long_clean_texts_do_not_add_up_to_toxic_ones(spark):
    r = random.Random(3)
    plain = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]

    def text(n, strays):
        words = r.choices(plain, k=n)
        for at in r.sample(range(n), strays):
            words[at] = "zorgblat."
        return " ".join(w + "." * (i % 9 == 8) for i, w in enumerate(words))

    toxic = "you zorgblat. such a zorgblat! all zorgblat."
    rows = [(i, f"{text(30, 0)}. {toxic} {text(30, 0)}", 1) for i in range(60)]
    rows += [(i, text(n := r.choice((60, 100, 200, 2000)), n // 400), 0) for i in range(60, 300)]
    rows += [(i, text(20_000, 50), 0) for i in range(300, 310)]
    rows += [(i, f"{text(10_000, 25)}. {toxic * 3} {text(10_000, 25)}", 1) for i in range(310, 315)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 300],
                                   "doc_id bigint, toxic int")
    got = {x["doc_id"]: x["predicted"] for x in toxicity.score_toxicity(
        docs, toxicity.learn(docs, labels)).collect()}
    assert sum(got[i] for i in range(300, 310)) == 0
    assert sum(got[i] for i in range(310, 315)) == 5
    assert sum(got[i] for i in range(60)) >= 57 and sum(got[i] for i in range(60, 300)) <= 5


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(1)
    bags = [r.normal(size=(n, 5)) for n in (1, 3, 4)]
    y, weight = np.array([0.0, 1.0, 1.0]), np.array([1.5, 0.7, 0.7])
    net = quality_mil.train_network(bags, y, hidden=4, gate=3, epochs=1)
    x, first = np.concatenate(bags), np.array([0, 1, 4])

    def loss():
        p = net.forward(x, first)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    for name, grad in quality_mil._gradients(net, x, first, y, weight).items():
        w = getattr(net, name)
        at = tuple(0 for _ in w.shape)
        keep = w[at]
        w[at] = keep + 1e-6
        up = loss()
        w[at] = keep - 1e-6
        assert (up - loss()) / 2e-6 == pytest.approx(grad[at], rel=1e-4, abs=1e-8)
        w[at] = keep


# --- shards and chats -------------------------------------------------------------------

def test_shards_of_the_documents(spark, documents):
    import zlib
    rows = queries.op9_sharding(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(documents) and len(rows) == len(documents)
    slots = defaultdict(list)
    for r in rows:
        raw = (documents[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    by_place = sorted(rows, key=lambda r: (r["slot"], r["shard"]))
    order = [r["doc_id"] for r in by_place]
    assert order != sorted(order)
    again = sharding.assign_shards(spark.read.parquet(f"{SF}/documents.parquet").repartition(7))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_templates_are_read_back(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "<", "|", "a\nb", "",
             "<|im_end|>\n", "<<|", None]
    rows = [(i, t, role, text) for i, a in enumerate(texts)
            for t, (role, text) in enumerate([("user", a), ("assistant", a), ("sys tem\n<|", a)])]
    df = spark.createDataFrame(rows, "id bigint, turn bigint, role string, text string")
    out = chat_format.format_turns(chat_format.canonical_table(df, "id")).select(
        "id", chat_format.read_turns(F.col("formatted")).alias("back"), "turns",
        chat_format.under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["back"] == r["turns"]
        assert r["loss"] == (texts[r["id"]] or "")


def test_layouts_are_told_by_their_fields(spark):
    records = {
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}': 2,
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}],"id":7}': 2,
        '{"prompt":"q","response":"a","source":"x"}': 2,
        '{"prompt":"q","completion":"a"}': 2,
        '{"instruction":"q","output":"a"}': 2,
        '{"instruction":"q","input":"more","output":"a"}': 2,
        '{"question":"q"}': None, "not json": None}
    df = spark.createDataFrame([(r,) for r in [*records, None]], "record string")
    for r in chat_format.canonical_json(df, "record").collect():
        turns = r["turns"]
        if records.get(r["record"]) is None:
            assert turns is None
        else:
            assert [t["role"] for t in turns] == ["user", "assistant"]
            assert turns[0]["text"].split("\n")[0] == "q" and turns[1]["text"] == "a"
    table = spark.createDataFrame([(1, "q", "a")], "id bigint, instruction string, output string")
    assert chat_format.canonical_table(table, "id").first()["turns"][1]["text"] == "a"
    with pytest.raises(ValueError):
        chat_format.canonical_table(spark.range(1), "id")


# --- the whole --------------------------------------------------------------------------

def test_pipeline_agrees_with_plain_steps(spark, documents, library, tables):
    import corpus_pipeline
    docs = tables("documents")
    grammar = toxicity.learn(docs, tables("labels"))
    reader = toxicity.Reader(grammar)
    clean = {i: t for i, t in documents.items()
             if 1 / (1 + math.exp(-grammar.slope * (
                 math.log1p(reader.evidence(t or "")) - grammar.centre))) < 0.5}
    best = {}
    for i, t in clean.items():
        best[t or ""] = max(i, best.get(t or "", i))
    single = {i: clean[i] for i in best.values()}
    groups = brute.components([(i, brute.fingerprint(t)) for i, t in single.items()])
    far = {i: t for i, t in single.items() if groups[i] == i}
    bench = [(r["item_id"], r["text"]) for r in tables("benchmark").collect()]
    left = {i: t for i, t in far.items() if not brute.contamination(t, bench)[1]}
    assert len(documents) > len(clean) > len(single) >= len(far) > len(left) > 0
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(left) and len(rows) == len(left)
    for r in rows:
        ids = [library.bos_id(), *library.encode(left[r["doc_id"]] or ""), library.eos_id()]
        assert r["ids_sha256"] == brute.sha(np.array(ids, "<u4").tobytes())


def test_stages_keep_columns_and_survive_odd_tables(spark, odd, none):
    import corpus_pipeline
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, SF)
            rows = out.count()
            assert rows <= docs.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_library_works_without_this_subpackage(tmp_path):
    for name in ("medallion", "workload", "__spark_entry__.py"):
        source = os.path.join(REPO, name)
        target = tmp_path / name
        if os.path.isdir(source):
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, target)
    code = ("import __spark_entry__ as e; q = e.queries(); "
            "print(len(q), any(k.startswith('op') for k in q), len(e.oracle_sql()))")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                          text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr[-500:]
    assert done.stdout.split()[1] == "False" and int(done.stdout.split()[0]) > 90
