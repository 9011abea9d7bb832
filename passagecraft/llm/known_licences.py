"""Licence texts that licence scans look for, without their copyright lines."""

from __future__ import annotations

from pathlib import Path

# Public licence texts.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ISC = f"{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{ISC_DISCLAIMER}"
ZERO_BSD = f"{ISC_GRANT}.\n\n{ISC_DISCLAIMER}"

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>"""

# (name, kind, text): whole licences, and notices that name one.
KNOWN = [
    ("MIT", "licence", MIT),
    ("MIT", "licence", "MIT License\n\n" + MIT),
    ("MIT", "licence", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", "licence", ISC),
    ("ISC", "licence", "ISC License\n\n" + ISC),
    ("0BSD", "licence", ZERO_BSD),
    ("BSD-2-Clause", "licence", BSD_HEAD + BSD_DISCLAIMER),
    ("BSD-3-Clause", "licence", BSD_HEAD + BSD_THIRD + BSD_DISCLAIMER),
    ("Zlib", "licence", ZLIB),
    ("Unlicense", "licence", UNLICENSE),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
]

# Whole texts of long licences, one file each, with how the licence is named here.
LONG = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
    "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
    "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
END = "END OF TERMS AND CONDITIONS"


def _long_texts() -> list[tuple[str, str, str]]:
    """Each text whole, and the terms alone where instructions follow them, with and without the line that ends them.

    A filled-in copyright line is no part of the canonical form, so the one to be filled in goes too.
    """
    out = []
    for file, name in LONG.items():
        text = (Path(__file__).parent / "licences" / f"{file}.txt").read_text(encoding="utf-8")
        forms = [text, text.replace("Copyright [yyyy] [name of copyright owner]", "")]
        if END in text:
            terms = text[: text.index(END)]
            forms += [terms + END, terms]
        out += [(name, "licence", form) for form in dict.fromkeys(forms)]
    return out


def _gnu(full: str, short: str, version: str) -> list[str]:
    plain = version.removesuffix(".0")
    names = [f"{full}, version {v}" for v in {version, plain}] + [f"{full} v{v}" for v in {version, plain}]
    names += [f"{s} {v}" for s in (short, f"GNU {short}") for v in {version, plain, f"v{version}", f"v{plain}", f"version {plain}"}]
    names += [f"{s}v{v}" for s in (short, f"GNU {short}") for v in {version, plain}]
    return [n + more for n in names for more in ("", " or later", " only", ", or (at your option) any later version")]


def _creative(kind: str, full: str, version: str) -> list[str]:
    long = [f"Creative Commons {full} {version}", f"Creative Commons {full} {version} International"]
    return [f"CC {kind} {version}", f"CC {kind} {version} International", *long, *(f"{n} License" for n in long), f"CC {kind} {version} License"]


# How notices name each licence.
NAMES = {
    "MIT": ["MIT License", "MIT"], "ISC": ["ISC License", "ISC"], "0BSD": ["0BSD License", "Zero-Clause BSD License"], "Zlib": ["zlib License"], "Unlicense": ["Unlicense"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
} | {f"GPL-{v}": _gnu("GNU General Public License", "GPL", v) for v in ("1.0", "2.0", "3.0")} | {
    f"LGPL-{v}": _gnu("GNU Library General Public License" if v == "2.0" else "GNU Lesser General Public License", "LGPL", v) for v in ("2.0", "2.1", "3.0")
} | {"AGPL-3.0": _gnu("GNU Affero General Public License", "AGPL", "3.0")} | {
    f"GFDL-{v}": _gnu("GNU Free Documentation License", "GFDL", v) for v in ("1.2", "1.3")
} | {
    f"CC-{kind}-{v}": _creative(kind, full, v) for v in ("2.0", "2.5", "3.0", "4.0") for kind, full in {
        "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items()
}
OPENINGS = ["Licensed under", "Released under", "Distributed under"] + [
    f"This {what} is {how} under" for what in ("work", "software", "project", "program") for how in ("licensed", "released")]


def _notices() -> list[tuple[str, str, str]]:
    out = [(name, "notice", f"SPDX-License-Identifier: {name}{more}") for name in NAMES for more in ("", "-only", "-or-later", "+") if not more or "GPL" in name or "GFDL" in name]
    out += [(name, "notice", f"{opening} {the}{form}.") for name, forms in NAMES.items() for form in forms for opening in OPENINGS for the in ("", "the ")]
    return [(name, "notice", text) for name, _, text in sorted(set(out))]


KNOWN += _long_texts()
KNOWN += _notices()
