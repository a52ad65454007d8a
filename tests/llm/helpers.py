"""Small document tables with the awkward cases every operator must define."""

LONG = " ".join(f"word{i % 977} x{i}" for i in range(12_000))  # over 100,000 characters

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away today."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (None, "a row without an id stays a row of its own, whatever else happens here"),
    (5, "The quick brown fox jumps over the lazy dog and runs far away today."),
    (5, "The quick brown fox jumps over the lazy dog and runs far away today."),
    (6, LONG),
    (7, "é ü 漢字 🙂 <|endoftext|> end\u0085 of it"),
    (8, "line one\nline one\n\nLINE ONE \nlast"),
]
SCHEMA = "doc_id long, text string"


def table(spark, rows=ROWS, clash=()):
    """Documents with further columns, named like those the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for name in clash:
        df = df.withColumn(name, F.lit(7))
    return df


CLASHING = ("rk", "row", "words", "kept", "sha", "fp", "n", "spans", "h", "component_id", "norm", "root")


def doc_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
