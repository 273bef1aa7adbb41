"""License scans in DataFrame operations: sparse TF-IDF cosine to templates, then inheritance from directories.

Three kinds of pieces of a text are compared with short notices, SPDX lines, titles, headers and whole licences: each
line, each block of several lines (lines without an empty one between them), and the whole text. What tells a licence
from its kin, such as its version, must be among a piece's words as well. A line or block whose cosine to a template
reaches the threshold is a header; a text that is yet closer (``WHOLE``) as a whole, that has nothing but headers, or that is so named
and has a header, is a licence file. Term weights are the document frequencies of the template terms over all texts.
A piece can reach the threshold only if it holds a term outside the set of commonest terms whose joint weight stays
below it in every template, so pieces without such a term are skipped without loss. A path without a licence of its
own takes that of the licence file in the nearest directory above it, the root being the last.

Edge cases: null and empty texts have no licence of their own but may inherit; equal scores go to the smaller name;
rows are told apart by id, path and text, null or not, so repeated rows give repeated results and several texts under
one id don't mix; several licence files in a directory give the best score's; a null path inherits nothing; only the
named columns are read.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import table, written

THRESHOLD = 0.7
#: A whole text this close to a template is a licence file; below it may be a short file under a header.
WHOLE = 0.9
#: Short notices by licence (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}

#: Names of licences by SPDX identifier (fixed values).
NAMES = {
    "0BSD": ["Zero-Clause BSD License"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC-BY-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0 Unported"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["CC0 1.0 Universal"],
    "CDDL-1.0": ["Common Development and Distribution License, Version 1.0"],
    "EPL-1.0": ["Eclipse Public License, Version 1.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"],
    "EUPL-1.2": ["European Union Public Licence, Version 1.2"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL version 2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL version 3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MIT": ["MIT License"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "MS-PL": ["Microsoft Public License"],
    "NCSA": ["University of Illinois/NCSA Open Source License"],
    "PostgreSQL": ["PostgreSQL License"],
    "Unlicense": ["The Unlicense"],
    "Zlib": ["zlib License"],
}
#: Forms of a notice; the name stands in the braces.
FORMS = ("Licensed under the {}", "This work is licensed under {}", "Released under the {}")
#: Words of names that many licences share, besides which all words of a name must be there.
SHARED = frozenset("a and general gnu international licence license open public software source the universal unported version".split())
#: First lines of licence files (fixed values).
TITLES = {
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Apache-2.0": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
}
#: What must be in pieces that are like the notices, titles and texts of these licences.
NEEDED = {
    "AGPL-3.0": ("affero", "3"), "Apache-2.0": ("apache", "2.0"), "CC-BY-NC-4.0": ("nc", "4.0"), "GPL-2.0": ("2",), "GPL-3.0": ("3",), "LGPL-2.1": ("lesser", "2.1"),
    "LGPL-3.0": ("lesser", "3"), "MIT": (), "MPL-2.0": ("mozilla", "2.0"),
}


_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details.\n\nYou should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."
#: Whole licences, and the headers of those that are too long to repeat (fixed values).
WHOLE_TEXTS = {
    "AGPL-3.0": _GPL.format("Affero General Public License", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": f"{_BSD_HEAD}\n\n{_BSD_TAIL}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n\n{_BSD_NAMES}\n\n{_BSD_TAIL}",
    "GPL-2.0": _GPL.format("General Public License", "2"),
    "GPL-3.0": _GPL.format("General Public License", "3"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-2.1": _GPL.format("Lesser General Public License", "2.1"),
    "LGPL-3.0": _GPL.format("Lesser General Public License", "3"),
    "MIT": f"{_GRANT}\n\n{_AS_IS}",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": f"This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n{_AS_IS}",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution.",
}


def words_in(text: str) -> list[str]:
    """The terms of a plain ASCII text, as ``terms`` finds them."""
    return re.sub(r"[^0-9a-z.]+|\.(?![0-9])", " ", text.lower()).split()


def variants(templates: dict[str, str] | None) -> list[tuple[str, str, list[str]]]:
    """``(licence, text, words that must be there)``: the given texts, or notices, SPDX lines, titles and whole texts."""
    if templates is not None:
        return [(k, t, []) for k, t in templates.items()]
    out = [(k, t, [*NEEDED.get(k, ())]) for d in (TEMPLATES, TITLES, WHOLE_TEXTS) for k, t in d.items()]
    for k, names in NAMES.items():
        out.append((k, f"SPDX-License-Identifier: {k}", words_in(k)))
        for name in names:
            needed = sorted({*words_in(name)} - SHARED)
            out += [(k, form.format(name), needed) for form in FORMS] + ([(k, name, needed)] if len(words_in(name)) > 3 else [])
    return out


def literal_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table as one literal, made without Python workers."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def terms(text: Column) -> Column:
    """Lower-case words of letters and digits, dots inside numbers kept."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\d)", " "), " +"), lambda w: w != "")


def weighted_templates(texts: DataFrame, templates: list[tuple[str, str, list[str]]]) -> tuple[list[dict], int]:
    """Rows ``(license, variant, term, w, idf, needed, lacks)`` of unit vectors, one for each term of each template, and the number of texts.

    ``needed`` is 1 for a word that must be there, ``lacks`` the number of such words of the template.
    """
    spark = texts.sparkSession
    given = [{"license": k, "variant": v, "text": t} for v, (k, t, _) in enumerate(templates)]
    needed = [{*words} for _, _, words in templates]
    wanted = (
        literal_rows(spark, given, "license:string,variant:int,text:string").select("license", "variant", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("license", "variant", "term").agg(F.count("*").alias("tf")).collect()
    )
    known = F.from_json(F.lit(json.dumps(sorted({r["term"] for r in wanted}))), "array<string>")
    held = texts.select(F.explode_outer(F.array_intersect(terms(F.coalesce("text", F.lit(""))), known)).alias("term"))
    df = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count("*").alias("n")).collect()}
    n = texts.count()
    idf = {r["term"]: 1 + math.log((1 + n) / (1 + df.get(r["term"], 0))) for r in wanted}
    sizes: dict[tuple[str, int], float] = {}
    for r in wanted:
        sizes[r["license"], r["variant"]] = sizes.get((r["license"], r["variant"]), 0.0) + (r["tf"] * idf[r["term"]]) ** 2
    return [
        {"license": r["license"], "variant": r["variant"], "term": r["term"], "w": r["tf"] * idf[r["term"]] / math.sqrt(sizes[r["license"], r["variant"]]), "idf": idf[r["term"]], "needed": int(r["term"] in needed[r["variant"]]), "lacks": len(needed[r["variant"]])}
        for r in wanted
    ], n


def telling_terms(rows: list[dict], threshold: float) -> list[str]:
    """Terms without which no piece reaches the threshold: the commonest are left out while their joint weight stays below it."""
    by_license: dict[tuple[str, int], dict[str, float]] = {}
    idf: dict[str, float] = {}
    for r in rows:
        by_license.setdefault((r["license"], r["variant"]), {})[r["term"]] = r["w"]
        idf[r["term"]] = r["idf"]
    common: set[str] = set()
    for t in sorted(idf, key=lambda x: (idf[x], x)):
        if all(math.sqrt(sum(w * w for u, w in own.items() if u in common or u == t)) < threshold for own in by_license.values()):
            common.add(t)
    return sorted(set(idf) - common)


def squares(words: Column) -> Column:
    """The sum of the squared numbers of each word: the j-th of equal words in a row adds 2j - 1."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("total"))

    def step(a: Column, w: Column) -> Column:
        run = F.when(w == a["last"], a["run"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(w.alias("last"), run.alias("run"), (a["total"] + 2 * run - 1).alias("total"))

    return F.aggregate(F.sort_array(words), start, step, lambda a: a["total"])


def cosines(pieces: DataFrame, key: list[str], rows: list[dict], n: int, threshold: float) -> DataFrame:
    """``(key, license, score)`` of pieces (key, words) that reach the threshold for some template of the licence.

    Only words of the templates are sent on; what the others add to a piece's length is summed before. Words outside
    the templates count with the largest weight, that of a word no text holds. A piece whose template words alone are
    too short a part of it for any cosine of the threshold goes before templates are looked at.
    """
    spark = pieces.sparkSession
    number = {t: k for k, t in enumerate(sorted({r["term"] for r in rows}))}
    weight = {r["term"]: r["idf"] for r in rows}
    known = literal_rows(spark, [{"term": t, "t": k, "idf": weight[t]} for t, k in number.items()], "term:string,t:int,idf:double")
    vectors = literal_rows(spark, [{k: r[k] for k in ("license", "variant", "w", "needed", "lacks")} | {"t": number[r["term"]]} for r in rows], "license:string,variant:int,w:double,needed:int,lacks:int,t:int")
    unseen = (1 + math.log(1 + n)) ** 2
    telling = F.from_json(F.lit(json.dumps(telling_terms(rows, threshold))), "array<string>")
    likely = pieces.where(F.arrays_overlap("words", telling)).withColumn("all", squares(F.col("words")))
    held = likely.select(*key, "all", F.explode("words").alias("term")).join(F.broadcast(known), "term")
    counted = held.groupBy(*key, "all", "t", "idf").agg(F.count("*").alias("tf"))
    x = F.col("tf") * F.col("idf")
    bags = counted.groupBy(*key, "all").agg(F.sum(x * x).alias("own"), F.sum(F.col("tf") * F.col("tf")).alias("tf2"), F.collect_list(F.struct("t", x.alias("x"))).alias("bag"))
    sized = bags.withColumn("size", F.sqrt(F.col("own") + unseen * (F.col("all") - F.col("tf2")))).where(F.sqrt("own") >= (threshold - 1e-6) * F.col("size"))
    dots = (
        sized.select(*key, "size", F.explode("bag").alias("b")).select(*key, "size", "b.t", "b.x").join(F.broadcast(vectors), "t")
        .groupBy(*key, "size", "license", "variant").agg(F.sum(F.col("x") * F.col("w")).alias("dot"), F.sum("needed").alias("held"), F.max("lacks").alias("lacks"))
        .where("held = lacks")
    )
    scores = dots.withColumn("score", F.round(F.col("dot") / F.col("size"), 6)).where(F.col("score") >= threshold)
    return scores.groupBy(*key, "license").agg(F.max("score").alias("score"))


def pieces_of(texts: DataFrame) -> DataFrame:
    """``(_k, kind, piece, words)``: lines (kind 0), blocks of several lines (1) and texts of several lines (2).

    A text is split into words once, line by line; the words of blocks and of the whole are those of their lines.
    """
    full = lambda x: F.trim(x) != ""
    by_block = F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda b: F.transform(F.filter(F.split(b, "\n"), full), terms))

    def of_kind(kind: int, pieces: Column) -> Column:
        return F.transform(pieces, lambda words: F.struct(F.lit(kind).alias("kind"), words.alias("words")))

    def every(blocks: Column) -> Column:
        lines = F.flatten(blocks)
        several = F.transform(F.filter(blocks, lambda b: F.size(b) > 1), F.flatten)
        whole = F.filter(F.array(F.flatten(lines)), lambda _: F.size(lines) > 1)
        return F.filter(F.concat(of_kind(0, lines), of_kind(1, several), of_kind(2, whole)), lambda p: F.size(p["words"]) > 0)

    # bound to a name, so that it is computed once; beside the array only the key goes along with each of its elements
    pieces = F.get(F.transform(F.array(by_block), every), F.lit(0))
    return texts.where("text is not null").select("_k", F.posexplode(pieces).alias("piece", "p")).select("_k", "p.kind", "piece", "p.words")


def scanned(docs: DataFrame, id_col: str, path: Column, text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``id_col, path, own_license, score, n_headers, is_file, license, inherited_from``."""
    named_rows = docs.select(F.col(id_col).alias("_id"), path.alias("_path"), F.col(text_col).alias("text"))
    key = F.xxhash64(F.col("_id").isNull(), "_id", F.col("_path").isNull(), "_path", F.col("text").isNull(), "text")
    texts = named_rows.select(key.alias("_k"), "_id", "_path", "text")
    rows, n = weighted_templates(texts, variants(templates))
    # equal rows share a key: their terms count twice, which leaves a cosine as it is
    found = written(cosines(pieces_of(texts), ["_k", "kind", "piece"], rows, n, threshold), "headers")
    best = found.groupBy("_k").agg(
        F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("license"))).alias("b"),
        F.countDistinct(F.when(F.col("kind") == 0, F.col("piece"))).alias("lines"), F.countDistinct(F.when(F.col("kind") == 1, F.col("piece"))).alias("blocks"),
        F.max((F.col("kind") == 2) & (F.col("score") >= WHOLE)).alias("whole"),
    )
    n_lines = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    named = F.upper(F.element_at(F.split("_path", "/"), -1)).rlike(r"^(LICEN[CS]E|COPYING|NOTICE)(\..*)?$")
    own = written(
        texts.select("_k", "_id", "_path", n_lines.alias("n_lines")).join(best, "_k", "left")
        .select("_k", "_id", "_path", F.col("b.license").alias("own"), F.col("b.score").alias("score"), (F.coalesce("lines", F.lit(0)) + F.coalesce("blocks", F.lit(0))).cast("long").alias("n_headers"),
                F.coalesce(F.col("b").isNotNull() & (F.col("whole") | F.coalesce(named, F.lit(False)) | (F.col("lines") >= F.col("n_lines"))), F.lit(False)).alias("is_file")),
        "own",
    )
    folder = F.regexp_replace("_path", "/?[^/]*$", "")
    files = own.where("is_file").withColumn("dir", folder).groupBy("dir").agg(F.min_by("own", F.struct(-F.col("score"), F.col("_path"))).alias("dir_license"))
    parts = F.split(folder, "/")
    above = F.filter(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))), lambda d: d != "")
    # the root stands above every path, so its licence is a constant and no key of the join
    root = files.where("dir = ''").first()
    # each folder once, however many paths stand in it
    steps = own.where("own is null and _path is not null").select(folder.alias("folder"), above.alias("above")).distinct().select("folder", F.explode("above").alias("dir"))
    nearest = steps.join(files.where("dir <> ''"), "dir").groupBy("folder").agg(F.max_by(F.struct("dir", "dir_license"), F.length("dir")).alias("up"))
    out = own.withColumn("folder", folder).join(nearest, "folder", "left")
    own_none = F.col("own").isNull()
    up = F.coalesce("up", F.when(F.col("_path").isNotNull() & F.lit(root is not None), F.struct(F.lit("").alias("dir"), F.lit(root["dir_license"] if root else None).cast("string").alias("dir_license"))))
    out = out.withColumn("up", up)
    return out.select(
        F.col("_id").alias(id_col), *([F.col("_path").alias("path")] if id_col != "path" else []), F.col("own").alias("own_license"), "score", "n_headers", "is_file",
        F.coalesce("own", "up.dir_license").alias("license"), F.when(own_none, F.col("up.dir")).alias("inherited_from"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source and language are the directories above them."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    return scanned(docs, "doc_id", path)
