"""License scans: whole texts and wrapped headers, brute-force TF-IDF cosines, null ids and paths, repeated rows."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from agrispark.llm import licenses

SCHEMA = "doc_id bigint, path string, text string"


def scan(spark, rows, **more):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as kind", "2 as term", "3 as license", "4 as _k")
    return licenses.scanned(docs, "doc_id", F.col("path"), **more).collect()


def wrapped(text, mark, width=60):
    lines, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            lines.append(mark + line.strip())
            line = ""
        line += " " + w
    return "\n".join([*lines, mark + line.strip()])


def test_whole_licences_and_wrapped_headers(spark):
    mit = "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + licenses.WHOLE_TEXTS["MIT"]
    apache = wrapped(licenses.WHOLE_TEXTS["Apache-2.0"].replace("\n", " "), "# ") + "\n\nimport os\n\n" + "\n".join(f"def function{i}(first{i}, second{i}):\n    return os.name{i}\n" for i in range(40))
    rows = [(1, "LICENSE", mit), (2, "a/x.py", "print(1)"), (3, "a/y.py", apache), (4, "b/COPYING.txt", wrapped(licenses.WHOLE_TEXTS["GPL-3.0"], "")), (5, "b/c/z.py", None), (6, "top.py", "x = 1"), (7, "d/copy.txt", licenses.WHOLE_TEXTS["BSD-2-Clause"]), (8, "d/e/f/g.py", "y")]
    got = {r.doc_id: (r.own_license, r.is_file, r.license, r.inherited_from) for r in scan(spark, rows)}
    assert got[1] == ("MIT", True, "MIT", None) and got[2] == (None, False, "MIT", "") and got[6] == (None, False, "MIT", "")
    assert got[3] == ("Apache-2.0", False, "Apache-2.0", None) and got[4] == ("GPL-3.0", True, "GPL-3.0", None)
    assert got[5] == (None, False, "GPL-3.0", "b") and got[7][:2] == ("BSD-2-Clause", True) and got[8] == (None, False, "BSD-2-Clause", "d")


def test_scores_equal_brute_force(spark):
    templates = {"A": "alpha beta gamma delta the of", "B": "beta gamma epsilon the the zeta"}
    texts = ["alpha beta gamma delta the of", "the of the of", "alpha beta the\ngamma delta of more", "beta gamma epsilon the zeta zeta", None, "", "other words here", "alpha beta gamma other delta", "alpha beta gamma delta the of"]
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    n = len(texts)
    df = Counter(w for t in texts for w in set(words(t or "")))
    known = {w for t in templates.values() for w in words(t)}
    vector = lambda t: {w: c * (1 + math.log((1 + n) / (1 + (df[w] if w in known else 0)))) for w, c in Counter(words(t)).items()}

    def cosine(a, b):
        x, y = vector(a), vector(b)
        size = lambda v: math.sqrt(sum(z * z for z in v.values()))
        return sum(z * y.get(w, 0) for w, z in x.items()) / (size(x) * size(y)) if x and y else 0.0

    got = {r.doc_id: (r.own_license, r.score) for r in scan(spark, [(i, f"p/{i}", t) for i, t in enumerate(texts)], templates=templates, threshold=0.6)}
    for i, t in enumerate(texts):
        pieces = [*(t or "").split("\n"), t or ""]
        best = max((round(cosine(p, text), 6), name) for p in pieces for name, text in templates.items())
        assert got[i] == ((None, None) if best[0] < 0.6 else (got[i][0], best[0])), (i, got[i], best)


def test_null_ids_paths_and_repeated_rows(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [(None, "a/LICENSE", mit), (None, "a/x", "code"), (1, None, mit), (2, None, "code"), (3, "a/y", "code"), (3, "a/y", "code"), (4, "a/z", "one text"), (4, "a/z", "another\n" + mit)]
    got = sorted(((r.doc_id, r.path, r.license) for r in scan(spark, rows)), key=str)
    assert got == sorted([(None, "a/LICENSE", "MIT"), (None, "a/x", "MIT"), (1, None, "MIT"), (2, None, None), (3, "a/y", "MIT"), (3, "a/y", "MIT"), (4, "a/z", "MIT"), (4, "a/z", "MIT")], key=str)
    assert sum(r.own_license is not None for r in scan(spark, rows)) == 3


def test_long_texts(spark):
    text = "some long line of words\n" * 20_000 + "\n" + licenses.TEMPLATES["MIT"]
    assert [r.own_license for r in scan(spark, [(1, "p/q", text)])] == ["MIT"]
