"""What a review measured: bytes that op2 sends and keeps, work that op5 repeats."""

import glob
import os
import random
import tempfile
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute

from medallion.llm import common, pieces, suffix_tree
from medallion.llm.bytewords import words_of
from medallion.llm.queries import model_path


def _chunk(texts):
    return pa.table({"_chunk": pa.array([0] * len(texts), pa.int64()), "_text": texts,
                     "_train": [True] * len(texts)})


def _sent(table, k):
    rows = table.filter(pa.compute.equal(table.column("k"), k))
    return {c: sum(len(b.as_py()) for b in rows.column(c))
            for c in ("hashes", "contexts", "suffixes", "counts")}


def test_a_pair_is_sent_as_one_hash_and_a_count():
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=200)) for _ in range(20)]
    pairs = {p for t in texts for p in zip(["", *t.split()], [*t.split(), "."])}
    sent = _sent(suffix_tree._ask(_chunk(texts), 7), 2)
    assert sum(sent.values()) == 12 * len(pairs), "a hash of 8 bytes, a count of 4"


def test_the_words_of_a_frequent_pair_are_told_once():
    texts = ["a b c"] * 3 + ["a b d"]
    asked = [suffix_tree._ask(_chunk(texts), 1) for _ in range(3)]
    asked = [t.set_column(2, "chunk", pa.array([i] * len(t), pa.int64()))
             for i, t in enumerate(asked)]
    pairs = pa.concat_tables(t.filter(pa.compute.equal(t.column("k"), 2)) for t in asked)
    answers = suffix_tree._answer(pairs, 9)
    longer = [suffix_tree._ask_longer(_chunk(texts), answers.slice(i, 1), 1, 3) for i in range(3)]
    named = [t.filter(pa.compute.equal(t.column("k"), 2)) for t in longer]
    assert [sum(len(b.as_py()) for b in t.column("hashes")) // 8 for t in named] == [4, 0, 0]
    listed = next(suffix_tree._listed(iter(suffix_tree._pairs(named[0]).to_batches()))).to_pydict()
    symbols = suffix_tree.symbols_of(words_of(pa.array(["a b c"])))
    s = symbols.symbol.view(np.int64).tolist()  # start, a, b, c, end
    want = {(s[0], s[1]): 12, (s[1], s[2]): 12, (s[2], s[3]): 9, (s[3], s[4]): 9}
    assert dict(zip(zip(listed["context"], listed["suffix"]), listed["n"])) == want
    grams = suffix_tree._longer(symbols.symbol, 2, symbols.symbol, symbols.place)[1:]
    assert sorted(listed["gram"]) == sorted(grams.view(np.int64).tolist())


def test_a_stored_result_leaves_no_shuffle_files(spark):
    root = spark.conf.get("spark.local.dir", tempfile.gettempdir())
    root = os.environ.get("SPARK_LOCAL_DIRS", root)

    def files():
        return set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True))

    before, setting = files(), spark.conf.get(common._CLEANUP)
    stored = common.store(spark.range(1000).repartition(3, "id"), "freed", free=True)
    until = time.time() + 10  # Spark removes them in the background
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert stored.count() == 1000 and spark.conf.get(common._CLEANUP) == setting


def test_a_part_is_encoded_once_whatever_stands_beside_it(monkeypatch):
    seen, plain = [], pieces.PrefixTable._part
    monkeypatch.setattr(pieces.PrefixTable, "_part",
                        lambda self, part: seen.append(part) or plain(self, part))
    table = pieces.PrefixTable(model_path())
    for text in ("thereof and\nthereof", "thereof\nand thereof", "and\tand thereof"):
        table.encode(text)
    assert len(seen) == len(set(seen))


def test_slices_and_shared_fronts_change_no_id(monkeypatch):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    rng = random.Random(7)
    letters = ["th", "e", "in", "er", ".", ",", "\n", " ", "  ", "é", "語", "🙂", "▁", "A", "1", "\0"]
    texts = ["", " ", "a ", *("".join(rng.choices(letters, k=rng.randint(1, 60)))
                              for _ in range(400))]
    monkeypatch.setattr(pieces, "SLICE_BYTES", 300)
    table = pieces.PrefixTable(model_path(), cache_entries=20)
    for text, (ids, back) in zip(texts, table.encode_all(texts), strict=True):
        want = lib.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert back == lib.decode(want), text
