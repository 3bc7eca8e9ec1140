"""Inputs and plain re-implementations shared by the tests of the training-data operators."""

import random
import re
import string

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")


def invented(rng: random.Random, n: int, stem: str = "w") -> str:
    out = []
    for i in range(n):
        out.append(f"{stem}{rng.randrange(10**6)}")
        out[-1] += rng.choice(["", "", "", ",", "."])
        if rng.random() < 0.08:
            out[-1] += "\n" + stem
    return " ".join(out)


def documents(spark, rows):
    """A documents table with an extra column that clashes with outputs of the operators."""
    from pyspark.sql import functions as F
    full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    for clash in ("kept", "score", "shard", "sequence_id", "leaks", "licenses", "component_id", "n_tokens", "__in0", "lang_pred"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


EDGE_ROWS = [(900001, None), (900002, ""), (900003, " \n\t "), (900004, "one"), (900005, "one"), (900006, "One two"),
             (None, "a row without an id that says something quite alone here"), (900007, "é" * 4000),
             (900008, "same words again " * 3000), (900009, "same words again " * 3000), (900009, "same words again " * 3000)]
