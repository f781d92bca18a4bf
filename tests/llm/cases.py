"""Small tables that hold the awkward cases, and plain versions of what the operators compute."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall(text or "")


def prose(random_, n, alphabet="abcdefghij"):
    return " ".join("".join(random_.choice(alphabet) for _ in range(random_.randint(1, 6))) for _ in range(n))


def documents():
    """Copies, near copies, shared lines, nulls, empty and long texts, repeated rows and ids."""
    r = random.Random(4)
    shared = ["This line is shared by very many documents, see " + prose(r, 6) for _ in range(3)]
    rows = []
    for i in range(60):
        lines = [prose(r, r.randint(3, 30)).capitalize() for _ in range(r.randint(1, 5))]
        if i % 3 == 0:
            lines.insert(r.randint(0, len(lines)), "  " + shared[i % 2].upper() + "\t")
        rows.append([i, "\n".join(lines), ["en", "de", None][i % 3], ["a", "b", "a", None, "é"][i % 5]])
    base = prose(r, 120).split(" ")
    for i in range(60, 90):
        copy = list(base)
        for _ in range(r.randint(0, 6)):
            copy[r.randrange(len(copy))] = prose(r, 1)
        rows.append([i, " ".join(copy), "en", "a"])
    rows += [[90, None, "en", "a"], [91, "", "en", "b"], [92, " \t\n \n", None, None], [93, "one two", "de", "b"], [94, "ONE Two", "de", "b"]]
    rows += [[95, prose(r, 30_000), "en", "a"], [96, "x" * 70_000 + " y z", "en", "b"], [97, "é" * 50 + " " + "ü ß ñ 漢字 🙂", "fr", "é"]]
    rows += [[None, rows[0][1], "en", "a"], [None, None, None, None], list(rows[5]), list(rows[5]), [5, "another text with the id of five, it is", "en", "a"]]
    return [(*row, None if row[1] is None else len(row[1])) for row in rows]


def table(spark, rows=None, extra=True):
    """The documents, with columns whose names operators use inside."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
    if extra:
        for name in ("score", "node", "size", "n_lines", "drops", "copies", "mix_rate", "Lang_Pred", "bucket"):
            docs = docs.withColumn(name, F.lit("clash"))
    return docs
