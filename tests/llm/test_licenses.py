"""License scans: whole license files, headers, tags, and inheritance against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from courtside.llm import license_scan as L
from courtside.llm.license_texts import _BSD, _ISC, _MIT, TEMPLATES, TEXTS, TITLES

HOLDER = "Copyright (c) 2021 Some Person"


def wrapped(paragraphs, width=60, mark=""):
    """Paragraphs as lines of a file, an empty one between them."""
    lines = []
    for paragraph in paragraphs:
        line = mark
        for word in paragraph.split():
            if len(line) + len(word) > width:
                lines.append(line)
                line = mark
            line += (" " if line else "") + word
        lines += [line, mark]
    return "\n".join(lines)


@pytest.fixture(scope="module")
def found(spark):
    prose = "The river ran past the old mill and nobody had a license to fish in it.\nWithout warranty she sold the boat. " * 3
    files = {
        "/mit/LICENSE": wrapped([HOLDER, *_MIT]),
        "/titled/LICENSE": wrapped(["MIT License", HOLDER, *_MIT]),
        "/isc/LICENSE.md": wrapped([HOLDER, *_ISC]),
        "/bsd2/LICENSE": wrapped([HOLDER, *_BSD[:3], _BSD[4]]),
        "/bsd3/LICENSE": wrapped([HOLDER, *_BSD]),
        "/gpl/COPYING": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + prose,
        "/gpl3/COPYING": "GNU GENERAL PUBLIC LICENSE\nVersion 3\n\n" + prose,
        "/one/a.c": '// Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.\nint x;',
        "/head/a.py": wrapped([HOLDER, next(t for _, t in TITLES if t.startswith('Licensed under') and len(t) > 300)], mark="#") + "\nimport os\n",
        "/gplhead/a.c": wrapped(["Part of a program.", next(t for i, t in TITLES if i == "GPL-2.0" and "redistribute" in t)], mark=" *") + "\nint y;",
        "/tag/a.rs": "fn main() {}\n// SPDX-License-Identifier: Apache-2.0 OR MIT\n",
        "/bare/a.rs": "// SPDX-License-Identifier:\nfn main() {}\n",
        "/prose/a.txt": prose, "/long/a.txt": prose * 300, "/empty/LICENSE": "", "/null/LICENSE": None,
        "/mit/src/deep/b.c": "int z;", "/gpl/LICENSE.old": "nothing here", "/mit/src/c.c": "int c;",
    }
    rows = spark.createDataFrame([*files.items(), ("/mit/src/c.c", "int c;"), (None, "// SPDX-License-Identifier: ISC")], "path string, text string")
    rows = rows.withColumn("digest", F.lit(1)).withColumn("tag", F.lit("x")).withColumn("line", F.lit(7))
    return L.scan_licenses(rows, L.templates_table(spark, TEMPLATES + TITLES + TEXTS)).collect()


@pytest.mark.parametrize(("path", "expected"), [
    ("/mit/LICENSE", "MIT"), ("/titled/LICENSE", "MIT"), ("/isc/LICENSE.md", "ISC"), ("/bsd2/LICENSE", "BSD-2-Clause"),
    ("/bsd3/LICENSE", "BSD-3-Clause"), ("/gpl/COPYING", "GPL-3.0"), ("/gpl3/COPYING", "GPL-3.0"), ("/one/a.c", "Apache-2.0"),
    ("/head/a.py", "Apache-2.0"), ("/gplhead/a.c", "GPL-2.0"), ("/tag/a.rs", "Apache-2.0 OR MIT"), ("/bare/a.rs", None),
    ("/prose/a.txt", None), ("/long/a.txt", None), ("/empty/LICENSE", None), ("/null/LICENSE", None), (None, "ISC"),
])
def test_own_license(found, path, expected):
    assert {r.own_license for r in found if r.path == path} == {expected}


def test_what_is_below_a_license_file(found):
    by = {r.path: r for r in found}
    assert (by["/mit/src/deep/b.c"].license, by["/mit/src/deep/b.c"].inherited_from) == ("MIT", "/mit")
    assert by["/gpl/LICENSE.old"].license == "GPL-3.0" and by["/tag/a.rs"].line == 1 and by["/tag/a.rs"].score == 1
    assert len([r for r in found if r.path == "/mit/src/c.c"]) == 2 and by["/prose/a.txt"].license is None


def test_inheritance_against_plain_python(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        folder = "".join(f"/{rng.choice('ab')}" for _ in range(rng.randint(0, 6)))
        name = rng.choice(["LICENSE", "COPYING.txt", "notice", "x.c", "licenses.c", f"f{i}.py", f"g{i}.py"])
        rows.append((folder + "/" + name, *rng.choice([(None, None), (None, None), (None, None), ("MIT", 1.0), ("ISC", 1.0), ("ISC", 0.8)])))
    rows.append((None, None, None))
    best = {}
    for path, name, score in rows:
        folder, _, base = (path or "/").rpartition("/")
        if name and base.lower().split(".")[0] in ("license", "copying", "notice"):
            best[folder] = max(best.get(folder, (0, "")), (score, name))

    def above(path):
        folder = path.rpartition("/")[0]
        while True:
            if folder in best:
                return best[folder][1], folder
            if not folder:
                return None, None
            folder = folder.rpartition("/")[0]

    found = L.inherit(spark.createDataFrame(rows, "path string, license string, score double")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.inherited, r.inherited_from) == ((None, None) if r.path is None else above(r.path)), r
