"""Licence texts and one-line notices that ``license_scan`` knows by default.

Long texts are in ``licenses/``, as their owners publish them.  Each is known
in its usual variants: with and without the appendix that says how to apply
it, with ``http`` and ``https`` addresses, with numbered and plain items.
"""

from __future__ import annotations

import os
import re

FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licenses")

WARRANTY_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
BSD_NO_NAME = """3. Neither the name of the {owner} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def _filed() -> list[tuple[str, str]]:
    out = []
    for file in sorted(os.listdir(FOLDER)):
        with open(os.path.join(FOLDER, file), encoding="utf-8") as f:
            text = f.read()
        short = re.split(r"(?m)^[^\n]*(?:How to Apply These Terms|APPENDIX: How to apply|ADDENDUM: How to use)", text)[0]
        ends = re.sub(r"(?m)^\s*END OF TERMS AND CONDITIONS\s*$", "", short)
        for body in {text, short, ends}:
            out += [(file[:-4], x) for x in {body, body.replace("https://", "http://"), body.replace("http://", "https://")}]
    return sorted(out)


def _short() -> list[tuple[str, str]]:
    bodies = [("BSD-2-Clause", ("BSD 2-Clause License", "Simplified BSD License"), BSD_2 + WARRANTY_BSD),
              *[("BSD-3-Clause", ("BSD 3-Clause License", "New BSD License"), BSD_2 + BSD_NO_NAME.format(owner=o) + WARRANTY_BSD.replace(
                  "COPYRIGHT HOLDERS AND", h).replace("COPYRIGHT HOLDER OR", i))
                for o, h, i in (("copyright holder", "COPYRIGHT HOLDERS AND", "COPYRIGHT HOLDER OR"),
                                ("copyright holder", "COPYRIGHT HOLDERS AND", "COPYRIGHT OWNER OR"),
                                ("University", "REGENTS AND", "REGENTS OR"))],
              ("Zlib", ("zlib License",), ZLIB), ("Unlicense", ("The Unlicense",), UNLICENSE),
              ("Unlicense", ("The Unlicense",), UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"),
              ("Unlicense", ("The Unlicense",), UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org/>"),
              ("BSL-1.0", ("Boost Software License - Version 1.0 - August 17th, 2003",), BSL)]
    out = []
    for name, titles, body in bodies:
        for text in {body, re.sub(r"(?m)^\d\. ", "* ", body)}:
            for title in ("", *titles, *(f"The {t}" for t in titles if not t.startswith("The"))):
                for rights in ("", "All rights reserved.\n\n") if name.startswith("BSD") else ("",):
                    out.append((name, f"{title}\n\n{rights}{text}"))
    return out


#: the names that notices give to a licence
NAMES = {
    "MIT": ("MIT License", "MIT", "Expat License"),
    "ISC": ("ISC License", "ISC"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License Version 2.0", "Apache License 2.0", "Apache License v2.0",
                   "Apache 2.0 License", "Apache 2.0", "Apache License, Version 2.0 (the \"License\")"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD 2-Clause", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD 3-Clause", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSD": ("BSD License",),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0 License"),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"),
    "Unlicense": ("Unlicense", "Unlicense License"),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "Artistic-1.0-Perl": ("Artistic License",),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0", "CC0", "Creative Commons Zero v1.0 Universal License"),
}
for _short_name, _long, _versions in (("GPL", "GNU General Public License", ("2", "3")), ("AGPL", "GNU Affero General Public License", ("3",)),
                                      ("LGPL", "GNU Lesser General Public License", ("2.1", "3"))):
    for _v in _versions:
        _id = f"{_short_name}-{_v if '.' in _v else _v + '.0'}"
        _forms = [f"{n}{sep}{p}{_v}{z}" for n in (_long, f"GNU {_short_name}", _short_name) for sep, p in ((" ", "v"), (", ", "version "), (" ", ""))
                  for z in (("",) if "." in _v else ("", ".0"))]
        NAMES[_id] = (*_forms, f"{_short_name}v{_v}", f"{_short_name}v{_v} License")
        NAMES[f"{_id}-or-later"] = tuple(f"{n}{tail}" for n in (*_forms, f"{_short_name}v{_v}") for tail in (" or later", " or any later version", " or (at your option) any later version"))
for _kind, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                      ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v in ("3.0", "4.0"):
        _end = "International" if _v == "4.0" else "Unported"
        _names = [f"CC {_kind} {_v}", f"CC-{_kind}-{_v} License", f"Creative Commons {_words} {_v}", f"Creative Commons {_words} {_v} License",
                  f"Creative Commons {_words} {_v} {_end} License"]
        NAMES[f"CC-{_kind}-{_v}"] = tuple(_names)

SUBJECTS = ("", "This work is ", "This software is ", "This project is ", "This program is ", "This library is ", "This file is ", "This code is ")
VERBS = ("licensed", "released", "distributed", "available")
LINKS = ("under ", "under the ", "under the terms of the ")
#: identifiers of SPDX lines, and what they are called here if not the same
SPDX = {**{n: n for n in NAMES if n != "BSD"}, **{f"{n}-only": n for n in NAMES if "GPL" in n and not n.endswith("later")},
        "0BSD": "0BSD", "GFDL-1.2-only": "GFDL-1.2", "GFDL-1.3-only": "GFDL-1.3", "EPL-1.0": "EPL-1.0", "EPL-2.0": "EPL-2.0",
        "Python-2.0": "Python-2.0", "WTFPL": "WTFPL", "MIT-0": "MIT-0", "OFL-1.1": "OFL-1.1", "Artistic-2.0": "Artistic-2.0"}


def _notices() -> list[tuple[str, str]]:
    out = [(to, f"SPDX-License-Identifier: {n}") for n, to in SPDX.items()]
    for name, names in NAMES.items():
        for n in names:
            out.append((name, f"License: {n}"))
            out += [(name, f"{s}{v} {link}{n}.") for s in SUBJECTS for v in VERBS for link in LINKS]
    for short, long in (("GPL", "GNU General Public License"), ("AGPL", "GNU Affero General Public License"), ("LGPL", "GNU Lesser General Public License")):
        what = "library" if short == "LGPL" else "program"
        for v in {"GPL": ("2", "3"), "AGPL": ("3",), "LGPL": ("2.1", "3")}[short]:
            out.append((f"{short}-{v if '.' in v else v + '.0'}-or-later", f"This {what} is free software: you can redistribute it and/or modify it under the "
                        f"terms of the {long} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."))
    out += [("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                        f"distributed with this file, You can obtain one at {http}://mozilla.org/MPL/2.0/.") for http in ("http", "https")]
    out.append(("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."))
    out.append(("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."))
    # one of those that differ in signs alone
    return list({(n, re.sub(r"\W+", " ", t.lower()).strip()): (n, t) for n, t in out}.values())


def more_licenses() -> tuple[tuple[str, str], ...]:
    return tuple(dict.fromkeys([*_filed(), *_short(), *_notices()]))
