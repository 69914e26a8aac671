"""Tables of awkward rows for the operator tests."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
# what an operator would like to call its own columns
CLASHES = ("fingerprint", "component_id", "n_links", "score", "predicted", "n_tokens", "n_bytes",
           "over_limit", "ids_sha256", "decoded_sha256", "held_out", "_key", "_fp", "_text", "_c0",
           "set", "root", "hi", "n_shingles", "part", "mask", "id", "digest", "_s", "_n",
           "_lane", "_h", "n_hit", "hits", "keep_id", "group_size", "kept", "text_sha256")


def documents(spark, rows, extra=CLASHES):
    """(doc_id, text) rows as a documents table with clashing extra columns."""
    schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint"
              + "".join(f", `{c}` string" for c in extra))
    full = [(i, t, None if n % 3 == 0 else "en", None, None if t is None else len(t),
             *[f"x{n}"] * len(extra)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from here today"
LONG = " ".join(f"word{i % 977} tail" for i in range(12_000))
ODD_ROWS = [
    (1, PLAIN), (2, PLAIN), (2, PLAIN), (3, None), (4, ""), (5, "   \n\t "), (None, PLAIN),
    (None, None), (6, "x" * 50_000), (7, LONG), (8, LONG + " more"), (9, "one"),
    (10, "Ünïcode ▁ ﷽ 漢字 🙂 \x00 <|im_end|> <s>"), (11, PLAIN.upper()), (12, PLAIN + "."),
]
