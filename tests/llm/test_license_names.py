"""Notices by name, SPDX lines, titles and versions."""

import pytest

from agrispark.llm import licenses as L

GPL2 = L._GPL.format("General Public License", "2").replace("free software: you", "free software; you").replace("If not, see <https://www.gnu.org/licenses/>.", "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")
GPL3_PAGE = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n                            Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n"
FOUND = {
    "SPDX-License-Identifier: MIT": "MIT",
    "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0": "GPL-2.0",
    "SPDX-License-Identifier: CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "Licensed under the MIT license.": "MIT",
    "This work is licensed under CC BY-SA 4.0": "CC-BY-SA-4.0",
    "This work is licensed under CC BY 4.0": "CC-BY-4.0",
    "Creative Commons Attribution 4.0 International": "CC-BY-4.0",
    "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
    "Released under the Mozilla Public License 2.0": "MPL-2.0",
    "Licensed under the Eclipse Public License, Version 2.0": "EPL-2.0",
    "Licensed under the BSD 2-Clause License": "BSD-2-Clause",
    "Licensed under the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
    GPL2: "GPL-2.0",
    GPL3_PAGE: "GPL-3.0",
    L.WHOLE_TEXTS["LGPL-2.1"]: "LGPL-2.1",
}
NOT_FOUND = ["SPDX-License-Identifier: Foo-1.0", "Licensed under the Foo License, Version 7", "This work is licensed under CC BY 9.0", "mit der Lizenz", "the license of the software", "version 2"]


@pytest.fixture(scope="module")
def scanned(spark):
    texts = [*FOUND, *NOT_FOUND]
    filler = [(f"z/{k}", f"Some other words {k} of a text that the corpus holds, with the and of and version and mit.") for k in range(40)]
    df = spark.createDataFrame([(f"d{k}/file", t) for k, t in enumerate(texts)] + [("e/COPYING", GPL2), ("e/x.c", "int x;"), ("f/LICENSE", GPL3_PAGE), ("f/g/y.c", None), *filler], "path string, text string")
    return {r.path: r for r in L.scanned(df, "path", df["path"]).collect()}, texts


def test_names_and_versions(scanned):
    rows, texts = scanned
    assert {t: rows[f"d{k}/file"].own_license for k, t in enumerate(texts)} == {**FOUND, **dict.fromkeys(NOT_FOUND)}


def test_files_pass_their_version_down(scanned):
    rows, _ = scanned
    assert rows["e/COPYING"].is_file and rows["e/x.c"].license == "GPL-2.0"
    assert rows["f/LICENSE"].is_file and rows["f/g/y.c"].license == "GPL-3.0"


def test_every_name_is_found_in_every_form(spark):
    rows = [(f"{k}|{n}|{f}", form.format(name)) for k, names in L.NAMES.items() for n, name in enumerate(names) for f, form in enumerate(L.FORMS)] + [(f"{k}|s", f"SPDX-License-Identifier: {k}") for k in L.NAMES]
    df = spark.createDataFrame([(f"{k}/x", t) for k, t in rows], "path string, text string")
    got = {r.path.split("|")[0]: r.own_license for r in L.scanned(df, "path", df["path"]).collect()}
    assert got == {k: k for k in L.NAMES}
