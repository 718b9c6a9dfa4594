"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and to in is that it for was river stone winter garden paper window mountain letter harbour silver "
         "morning engine forest bridge market kitchen doctor season village captain music").split()


def prose(seed, n=120):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n)).capitalize() + "."


def documents(spark, texts, extra=False):
    """Rows (1, text), (2, text) ...; ``extra`` adds columns named like those the operators make."""
    rows = [(i + 1, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if not extra:
        return df
    names = ("shard", "slot", "size", "print", "component_id", "epoch", "budget", "tokens", "domain", "_m", "score", "word",
             "kept", "node", "key", "length", "sequence_id", "offset", "_rank", "_id")
    return df.selectExpr("*", *[f"'x' AS {n}" for n in names])


def awkward(spark, extra=False):
    """Nulls in every column, empty and blank texts, a long text, repeated rows and equal texts."""
    long = prose(1, 30_000)
    base = documents(spark, [None, "", " \t\n", "a", long, prose(2), prose(2), prose(3)], extra)
    nulls = base.limit(0).union(base.where("doc_id IN (4, 6)").selectExpr(
        *[f"CAST(NULL AS {t}) AS {c}" if c in ("doc_id", "lang", "source", "n_chars") else c for c, t in base.dtypes]))
    all_null = base.where("doc_id = 1").selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in base.dtypes])
    repeated = base.where("doc_id = 8")
    return base.union(nulls).union(all_null).union(repeated).union(repeated)


def values(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
