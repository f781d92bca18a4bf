import os
import subprocess
import sys
from collections import Counter

import pytest
import test_jaccard
import test_lines
from cases import documents, table

import corpus_pipeline as C
from landfall.llm import jaccard, langid, mixing

ROOT = os.path.dirname(os.path.abspath(C.__file__))


def ids(frame):
    return Counter(r["doc_id"] for r in frame.collect())


def test_every_stage_on_all_cases(spark):
    docs = table(spark)
    one = C.identify_language(spark, docs, "")
    assert one.columns == list(C.COLUMNS)
    letters = [d for d in documents() if any(c.isalpha() for c in d[1] or "")]
    assert ids(one) <= Counter(d[0] for d in letters) and sum(ids(one).values()) >= 0.9 * len(letters)

    two = C.drop_shared_lines(spark, table(spark), "")
    expected = test_lines.brute(documents())
    assert two.columns == list(C.COLUMNS)
    assert Counter((r["doc_id"], r["text"], r["n_chars"]) for r in two.collect()) == sum(
        (Counter({(e[0], e[1], len(e[1])): n}) for e, n in expected.items()), Counter()
    )

    three = C.drop_near_duplicates(spark, docs, "")
    # Each text of a group of its own or the smallest of one; the id 5 has two texts, and a null and two blank texts are like nothing.
    groups = Counter(c[2] for c in set(test_jaccard.brute(documents())) if c[1])
    assert three.columns == list(C.COLUMNS)
    assert ids(three) == Counter({**dict.fromkeys(groups, 1), 5: 2, None: 1, 90: 1, 91: 1, 92: 1})

    four = C.mix_sources(spark, docs, "")
    taken = Counter()
    for r in mixing.copies(docs).collect():
        taken[r["doc_id"]] += r["copies"]
    assert four.columns == list(C.COLUMNS) and ids(four) == +taken

    five = C.pack(spark, docs, "")
    assert sum(r["start"] == 0 for r in five.collect()) == len(documents())
    for _, stage in C.STAGES:
        assert stage(spark, table(spark, []), "").count() == 0


def test_clean_documents_stay_and_junk_goes(spark):
    rows = [(i, f"the house and the tree number {i} " * 3, "en", "a", 1) for i in range(30)] + [(99, "12 34 !!", "en", "a", 1)]
    assert ids(C.identify_language(spark, table(spark, rows), "")) == Counter(range(30))
    assert langid.UNKNOWN not in {r["lang"] for r in C.identify_language(spark, table(spark, rows), "").collect()}
    assert jaccard.PERCENT == 80 and [n for n, _ in C.STAGES][2] == "near_duplicates"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_pipeline_of_a_table(spark):
    got = C.run(spark, "/root/testdata/sf0.001")
    assert "ids" in got.columns and got.count() > 0


def test_nothing_else_imports_the_operators():
    code = "import sys; sys.modules['landfall.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(e.queries())[-1])"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == int(out[1]) and "pipeline" not in out[2]
