import os
import re
import textwrap
from collections import Counter

from cases import docs

from stellate.llm import license_scan
from stellate.llm.license_scan import LICENSES, PERMISSION_ISC, PERMISSION_MIT, SPELLINGS, known_licenses, scan_licenses
from stellate.llm.license_texts import BSD_2, BSD_NO_NAME, BSL, FOLDER, UNLICENSE, WARRANTY_BSD, ZLIB


def begins_notice(line):
    return bool(re.match(r"[\W_]*(copyright|©)[\W_]*(\(c\)|©)", line)
                or re.match(r"[\W_]*(copyright|\(c\)|©)[\W_]*(\d|[<\[{][^\W\d_])", line))


def canonical(text):
    """The three forms: lists of canonical lines without notice lines, without paragraphs that begin with one, and whole."""
    def words(line):
        return " ".join(w for x in re.findall(r"[^\W_]+", line) for w in dict(SPELLINGS).get(x, x).split())
    lines = [(begins_notice(x), words(x)) for x in (text or "").lower().split("\n")]
    paragraphs, now = [], []
    for notice, w in lines:
        if w:
            now.append((notice, w))
        elif now:
            paragraphs.append(now)
            now = []
    paragraphs.append(now)
    return ([w for n, w in lines if w and not n], [w for p in paragraphs if p and not p[0][0] for _, w in p], [w for _, w in lines if w])


def test_matches_brute_force(spark):
    mit = PERMISSION_MIT.replace("<year> <copyright holders>", "2024 Jane Doe")
    rows = [(1, mit), (2, mit.upper().replace("\n", "\r\n")), (3, mit + "\nmore words"), (4, "* Released under the MIT Licence!"),
            (5, "Some text.\nAll rights reserved.\nReleased under the MIT License.\nAll  rights -- reserved"), (6, None), (7, ""),
            (8, "(c) 2020 x\n...\n"), (9, "Copyright 2020 Y\nlicenced under the mit licence"), (5, "other"), (4, "* Released under the MIT Licence!"),
            (None, "All rights reserved."), (10, "licence licence licence"), (11, "x " * 50_000), (12, "all rights\nreserved")]
    known = {}
    for name, text in LICENSES:
        for form in canonical(text):
            if form:
                key = " ".join(form)
                known[key] = min(known.get(key, name), name)
    want = []
    for i, t in rows:
        forms = canonical(t)
        found = [known[x] for x in forms[0] if x in known]
        whole = next((known[" ".join(f)] for f in forms if " ".join(f) in known), None)
        want.append((-1 if i is None else i, whole, len(found), ",".join(sorted(set(found)))))
    got = [(-1 if r.doc_id is None else r.doc_id, r.license, r.n_notices, r.notices)
           for r in scan_licenses(docs(spark, rows, clashes=True), known_licenses(spark)).collect()]
    assert Counter(got) == Counter(want)
    assert sum(w[1] is not None for w in want) >= 7


def test_empty_tables(spark):
    none = spark.createDataFrame([], "license string, text string")
    assert scan_licenses(docs(spark, []), none).collect() == []
    r = scan_licenses(docs(spark, [(1, "")]), spark.createDataFrame([("E", "...")], "license string, text string")).first()
    assert (r.license, r.n_notices, r.notices) == (None, 0, "")


def test_common_licenses_are_known(spark):
    def filed(name):
        with open(os.path.join(FOLDER, f"{name}.txt")) as f:
            return f.read()
    whole = {n: filed(n) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")}
    whole["BSD-3-Clause"] = ("Copyright (c) 2020, J. Doe\nAll rights reserved.\n\n" + BSD_2 + BSD_NO_NAME.format(owner="copyright holder")
                             + WARRANTY_BSD)
    whole |= {"BSD-2-Clause": "BSD 2-Clause License\n\nCopyright (c) 2021 X\n\n" + (BSD_2 + WARRANTY_BSD).replace(" ", "\n  ", 9),
              "Unlicense": UNLICENSE, "Zlib": "Copyright (C) 1 Y\n\n" + ZLIB, "BSL-1.0": BSL,
              "MIT": PERMISSION_MIT.replace("MIT License", "The MIT License (MIT)")}
    notices = {"Distributed under the MIT license": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
               "// SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0", "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
               "Released under the GPL v3 or later.": "GPL-3.0-or-later", "This project is licensed under the terms of the MIT license.": "MIT",
               "Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0",
               "This work is licensed under a licence of its own.": "", "Licensed under the GNU LGPL v2.1": "LGPL-2.1"}
    rows = [(i, t) for i, t in enumerate([*whole.values(), *(f"Some words.\n{n}\nMore." for n in notices)])]
    got = {r.doc_id: r for r in scan_licenses(docs(spark, rows), known_licenses(spark)).collect()}
    assert [got[i].license for i in range(len(whole))] == list(whole)
    assert [got[len(whole) + i].notices for i in range(len(notices))] == list(notices.values())


def filed(name):
    with open(os.path.join(FOLDER, f"{name}.txt"), encoding="utf-8") as f:
        return f.read()


def refilled(text, width):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in re.split(r"\n\s*\n", text))


def test_every_full_text_is_found_at_ten_widths(spark):
    """Texts with a holder of their own, filled again paragraph by paragraph."""
    whole = {f[:-4]: filed(f[:-4]) for f in sorted(os.listdir(FOLDER))}
    holder = "2019-2024 The Example Project Developers and all of its many other contributors listed in the AUTHORS file"
    whole["MIT"] = PERMISSION_MIT.replace("<year> <copyright holders>", holder)
    whole["ISC"] = PERMISSION_ISC.replace("<year> <owner>", holder)
    whole["BSD-2-Clause"] = f"BSD 2-Clause License\n\nCopyright (c) {holder}\n\n" + BSD_2 + WARRANTY_BSD
    whole["BSD-3-Clause"] = f"Copyright (c) {holder}\n\n" + BSD_2 + BSD_NO_NAME.format(owner="copyright holder") + WARRANTY_BSD
    whole["Zlib"], whole["BSL-1.0"], whole["Unlicense"] = f"Copyright (C) {holder}\n\n" + ZLIB, BSL, UNLICENSE
    widths = range(55, 105, 5)
    rows = [(i, t) for i, t in enumerate(refilled(text, w) for text in whole.values() for w in widths)]
    got = {r.doc_id: r.license for r in scan_licenses(docs(spark, rows), known_licenses(spark)).collect()}
    names = [n for n in whole for _ in widths]
    assert {(names[i], widths[i % 10]): got[i] for i, _ in rows if got[i] != names[i]} == {}
    # and nothing else is: a changed word, or a list item of the text gone
    near = [(i, t.replace("conditions", "terms", 1) if "conditions" in t else t + " more") for i, t in enumerate(whole.values())]
    near += [(100, re.sub(r"(?m)^ *\(c\) .*$", "", whole["Apache-2.0"], count=1))]
    assert [r.license for r in scan_licenses(docs(spark, near), known_licenses(spark)).collect()] == [None] * len(near)


def test_known_texts_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate([PERMISSION_MIT, "All rights reserved.\nReleased under the MIT License.", None, "x"])]
    both = []
    for bound in (0, 1 << 18):
        monkeypatch.setattr(license_scan, "KNOWN_ROWS", bound)
        both.append(sorted(map(tuple, scan_licenses(docs(spark, rows), known_licenses(spark)).collect())))
    assert both[0] == both[1]
