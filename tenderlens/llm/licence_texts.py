"""Notices, headers, title blocks and whole texts of public licences, by SPDX id.

The sentences are fixed values: licences are found by the words their stewards ask to write. What differs only by a
version or a variant is made by a rule. Long licences (GPL, LGPL, AGPL, Apache, MPL, EPL, CC0) stand here with their title blocks
and the headers they prescribe; callers may pass whole texts of their own as further bodies.
"""

from __future__ import annotations

from collections.abc import Iterator

# GNU licences, their label, version and the date in their title.
GNU = [
    ("GPL", "General", "2.0", "June 1991"),
    ("GPL", "General", "3.0", "29 June 2007"),
    ("LGPL", "Library General", "2.0", "June 1991"),
    ("LGPL", "Lesser General", "2.1", "February 1999"),
    ("LGPL", "Lesser General", "3.0", "29 June 2007"),
    ("AGPL", "Affero General", "3.0", "19 November 2007"),
]
# Creative Commons variants and the ports of their versions.
CC_VARIANTS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}

# Notices, headers and title blocks.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "MIT License",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ],
    "EPL-1.0": ["Licensed under the Eclipse Public License v1.0", "Eclipse Public License - v 1.0"],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License v2.0",
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "BSD 2-Clause License"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License",
        "BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "ISC": ["ISC License", "Licensed under the ISC License"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0", "CC0 1.0 Universal"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
# Whole licence texts, and paragraphs that tell a licence by themselves.
BODIES = {
    "MIT": [
        _MIT_GRANT,
        _MIT_GRANT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "BSD-2-Clause": [_BSD_OPENING + _BSD_DISCLAIMER],
    "BSD-3-Clause": [_BSD_OPENING + _BSD_NAMES + _BSD_DISCLAIMER],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Zlib": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions:",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

#: Terms that tell variants of a licence apart: a match must agree in them.
VARIANTS = (
    "affero alike commercial derivatives endorse lesser nc nd neither noncommercial noderivatives noderivs sa sharealike"
).split()
#: Terms that tell versions apart; a body's numbers are those of its clauses and do not count.
VERSIONS = [f"{v}{k}" for v in ("", "v") for k in range(1, 10)]


def _by_rule() -> Iterator[tuple[str, str]]:
    for name, label, version, date in GNU:
        licence, say = f"{name}-{version}", version.removesuffix(".0")
        yield licence, f"This work is licensed under the GNU {label} Public License, version {say}"
        yield licence, f"Licensed under the GNU {label} Public License v{version}"
        yield licence, f"GNU {label} Public License Version {say}, {date}"
        for what in ("program", "library"):
            yield licence, (
                f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {label} Public "
                f"License as published by the Free Software Foundation, either version {say} of the License, or (at your option) "
                "any later version."
            )
        for extent in ("only", "or-later"):
            yield licence, f"SPDX-License-Identifier: {licence}-{extent}"
    for variant, words in CC_VARIANTS.items():
        for version, port in CC_VERSIONS.items():
            licence = f"CC-{variant}-{version}"
            yield licence, f"Licensed under CC {variant} {version}"
            yield licence, f"Licensed under a Creative Commons {words} {version} {port} License"
            yield licence, f"SPDX-License-Identifier: {licence}"


def _templates() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {name: list(texts) for name, texts in NOTICES.items()}
    for licence, text in _by_rule():
        out.setdefault(licence, []).append(text)
    for licence in sorted(NOTICES.keys() | BODIES.keys() | out.keys()):
        spdx = f"SPDX-License-Identifier: {licence}"
        if spdx not in out.setdefault(licence, []):
            out[licence].append(spdx)
    return out


#: Notices and headers by licence.
TEMPLATES: dict[str, list[str]] = _templates()
