"""Texts and notices of public licences, as published, and equivalent spellings.

``licenses/`` holds whole texts as published, one file each, named by SPDX id
(``_X`` marks a second text of one id). ``KNOWN`` has each of them with and
without its title, its appendix and "All rights reserved", the standard headers,
and notices: every name of every id in each of the forms in ``_forms``.
"""

import re
from pathlib import Path

# (licence id, text)
_TEXTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("all-rights-reserved", "All rights reserved."),
]

# Ids whose published text doesn't tell "only" from "or later".
_GNU = ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GFDL-1.2", "GFDL-1.3")
_FSF = ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
        "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA")
_ADDRESS = re.compile(r"(51 Franklin St(?:reet)?, Fifth Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA|59 Temple Place,? Suite 330,\s+Boston,\s+MA\s+02111-1307,?\s+USA|675 Mass Ave,\s+Cambridge,\s+MA\s+02139,\s+USA)")
_APPENDIX = re.compile(r"\n[ \t]*(?:APPENDIX: How to apply|(?:Appendix: )?How to Apply These Terms|ADDENDUM: How to use this License).*", re.S | re.I)
# Title lines of texts that are also published without them, and titles of texts stored without.
_TITLED = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
           "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD License", "BSD License"),
           "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "The BSD License", "BSD License"),
           "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "Zlib": ("zlib License", "The zlib/libpng License"), "Unlicense": ("The Unlicense", "Unlicense")}
_TITLE = re.compile(r"\s*(?:#? ?Apache License|#? ?Blue Oak Model License|Boost Software License|UNICODE LICENSE|Mozilla Public License|MOZILLA PUBLIC LICENSE|GNU [A-Z ]+LICENSE|Creative Commons Legal Code)[^\n]*\n(?:[ \t]*(?:Version |http)[^\n]*\n|[ \t=-]*\n)*")


def _ids(name: str) -> tuple[str, ...]:
    return (f"{name}-only", f"{name}-or-later") if name in _GNU else (name,)


def _published() -> list[tuple[str, str]]:
    out = []
    whole = [(f.stem.split("_")[0], f.read_text("utf-8")) for f in sorted(Path(__file__).with_name("licenses").glob("*.txt"))]
    for name, text in whole + [(i, t) for i, t in _TEXTS if i in ("MIT", "ISC") and len(t) > 500]:
        bodies = {text, _APPENDIX.sub("", text)}
        if name.startswith("BSD"):                          # clauses are published numbered, lettered and with marks
            for marks in (("1.", "2.", "3."), ("*", "*", "*"), ("a.", "b.", "c.")):
                body = text
                for mark, start in zip(marks, ("Redistributions of source", "Redistributions in binary", "Neither the name")):
                    body = re.sub(rf"(\n)[ \t]*(?:[0-9]\.|\*|-)?[ \t]*{start}", rf"\g<1>{mark} {start}", body)
                bodies.add(body)
        bodies |= {_ADDRESS.sub(a, x) for x in bodies for a in _FSF} | {_TITLE.sub("", x, count=1) for x in bodies}
        bodies |= {f"{t}\n{x}" for x in bodies for t in _TITLED.get(name, ())}
        if name in _TITLED:                                 # the line after the holder's
            bare = {re.sub(r"(?im)^[ \t]*all rights reserved\.?[ \t]*$", "", x) for x in bodies}
            bodies = bare | {re.sub(r"(?m)^(?=(?:Redistribution|Permission|This software is provided))", "All rights reserved.\n", x, count=1) for x in bare}
        out += [(i, x) for x in sorted(bodies) for i in _ids(name)]
    return out


_GNU_HEADER = """This program is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation{terms}
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details.
You should have received a copy of the GNU {kind}General Public License along with this {thing}{end}"""


def _headers() -> list[tuple[str, str]]:
    out = [("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
            f"You can obtain one at {site}mozilla.org/MPL/2.0/.") for site in ("http://", "http://www.")]
    out += [("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)")]
    for kind, name, versions in (("", "GPL", ("1", "2", "3")), ("Lesser ", "LGPL", ("2.1", "3")), ("Library ", "LGPL", ("2",)), ("Affero ", "AGPL", ("3",))):
        for v in versions:
            full = f"{name}-{v if '.' in v else v + '.0'}"
            for what, terms in (("or-later", (f", either version {v} of the License, or (at your option) any later version.",)),
                                ("only", (f", version {v} of the License.", f", version {v}."))):
                for thing in ("program", "library"):
                    ends = [". If not, see <http://www.gnu.org/licenses/>.", ". If not, see http://gnu.org/licenses/."]
                    ends += [f"; if not, write to the Free Software Foundation, Inc., {a}." for a in _FSF]
                    for term in terms:
                        for end in ends:
                            t = _GNU_HEADER.format(sep=":", kind=kind, terms=term, thing="program", end=end)
                            out.append((f"{full}-{what}", t if thing == "program" else t.replace("This program", "This library").replace("this program", "this library")))
    return out


# (licence id, the names it goes by in notices, without "the" and without "License" where that may follow)
_NAMES = [
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0", "Apache-2.0 License", "Apache Software License 2.0")),
    ("MIT", ("MIT License", "MIT", "MIT/X11 License", "Expat License")), ("MIT-0", ("MIT No Attribution License", "MIT-0", "MIT-0 License")),
    ("ISC", ("ISC License", "ISC")), ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD License", "0BSD", "0BSD License")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause", "BSD-2-Clause License", "Simplified BSD License", "FreeBSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause", "BSD-3-Clause License", "New BSD License", "Modified BSD License", "Revised BSD License")),
    ("BSD-4-Clause", ("BSD 4-Clause License", "4-Clause BSD License", "BSD-4-Clause", "Original BSD License")),
    ("MPL-1.1", ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1", "MPL-1.1")),
    ("MPL-2.0", ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0", "MPLv2")),
    ("EPL-1.0", ("Eclipse Public License, Version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0", "EPL 1.0", "EPL-1.0")),
    ("EPL-2.0", ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0", "EPL-2.0")),
    ("CDDL-1.0", ("Common Development and Distribution License, Version 1.0", "Common Development and Distribution License 1.0", "CDDL 1.0", "CDDL-1.0")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost Software License", "BSL-1.0")),
    ("EUPL-1.2", ("European Union Public Licence, Version 1.2", "European Union Public Licence 1.2", "EUPL 1.2", "EUPL-1.2", "EUPL v1.2")),
    ("Zlib", ("zlib License", "zlib", "zlib/libpng License")), ("Unlicense", ("Unlicense",)), ("WTFPL", ("WTFPL", "Do What The Fuck You Want To Public License")),
    ("Artistic-1.0-Perl", ("Artistic License 1.0", "Artistic-1.0-Perl")), ("Artistic-2.0", ("Artistic License 2.0", "Artistic License, Version 2.0", "Artistic-2.0")),
    ("PSF-2.0", ("Python Software Foundation License", "Python Software Foundation License Version 2", "PSF License", "PSF-2.0")),
    ("BlueOak-1.0.0", ("Blue Oak Model License 1.0.0", "Blue Oak Model License", "BlueOak-1.0.0")),
    ("OFL-1.1", ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "OFL 1.1", "OFL-1.1")),
    ("MS-PL", ("Microsoft Public License", "Ms-PL")), ("Unicode-3.0", ("Unicode License v3", "Unicode-3.0")),
    ("CC0-1.0", ("CC0", "CC0 1.0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal")),
]
for _parts, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v, _port in (("4.0", "International"), ("3.0", "Unported"), ("2.0", "Generic")):
        _n = (f"CC {_parts} {_v}", f"CC-{_parts}-{_v}", f"Creative Commons {_words} {_v}", f"Creative Commons {_words} {_v} {_port}", f"Creative Commons {_parts} {_v}")
        _NAMES.append((f"CC-{_parts}-{_v}", tuple(dict.fromkeys([*_n, *[f"{x} License" for x in _n]]))))
for _short, _words, _vs in (("GPL", "General Public License", "1 2 3"), ("LGPL", "Lesser General Public License", "2.1 3"), ("LGPL", "Library General Public License", "2"),
                            ("AGPL", "Affero General Public License", "3"), ("GFDL", "Free Documentation License", "1.2 1.3")):
    for _v in _vs.split():
        _id = f"{_short}-{_v if '.' in _v else _v + '.0'}"
        _full = dict.fromkeys(f"{g}{_words}{sep}{x}" for g in ("GNU ",) for sep in (", version ", " version ", " v", " ") for x in dict.fromkeys((_v, _id.split("-")[1])))
        _full |= dict.fromkeys(f"{g}{_short}{sep}{x}" for g in ("", "GNU ") for sep in ("v", " v", " version ", ", version ", "-", " ") for x in dict.fromkeys((_v, _id.split("-")[1])))
        _NAMES.append((f"{_id}-only", (*_full, f"{_id}-only")))
        _NAMES.append((f"{_id}-or-later", (*[x + tail for x in _full for tail in (" or later", " or any later version", " or (at your option) any later version")], f"{_id}-or-later")))


def _forms(name: str) -> list[str]:
    """Notices that name a licence."""
    verbs = ("licensed under", "released under", "distributed under")
    return [f"SPDX-License-Identifier: {name}", *[f"{who}{verb} {the}{name}." for who in ("", "This work is ", "This software is ", "This project is ") for verb in verbs for the in ("", "the ", "the terms of the ")]]


def _once(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Rows that differ in more than case and punctuation."""
    out: dict[tuple[str, str], tuple[str, str]] = {}
    for i, t in rows:
        out.setdefault((i, " ".join(re.findall(r"[^\W_]+", t.lower()))), (i, t))
    return list(out.values())


KNOWN = _once(_TEXTS + _published() + _headers() + [(i, t) for i, names in _NAMES for _, n in _once([(i, n) for n in names]) for t in _forms(n)])

# (pattern of a word's beginning, replacement with \\1 for what stands before it); words are lower case, separated by one space
SPELLINGS = [
    (r"(^|[ \n])sub ?licen[cs]", r"\1sublicens"),
    (r"(^|[ \n])licenc", r"\1licens"),
    (r"(^|[ \n])(author|categor|emphas|initial|maxim|minim|optim|organ|real|recogn|util|capital|custom|general)is(e|ing|ation)", r"\1\2iz\3"),
    (r"(^|[ \n])(fav|lab|behavi|col|hon)our", r"\1\2or"),
    (r"(^|[ \n])(judg|acknowledg)ement", r"\1\2ment"),
    (r"(^|[ \n])(off|def)ence", r"\1\2ense"),
    (r"(^|[ \n])(cent|calib)re", r"\1\2er"),
    (r"(^|[ \n])(catalog|analog)ue", r"\1\2"),
    (r"(^|[ \n])(model|signal|label|cancel)l(ed|ing)", r"\1\2\3"),
    (r"(^|[ \n])non ?commercial", r"\1noncommercial"),
    (r"(^|[ \n])per cent", r"\1percent"),
    (r"(^|[ \n])copyright owner", r"\1copyright holder"),
    (r"(^|[ \n])https", r"\1http"),
]
