"""Usual wordings of public licenses besides the short notices: headers, grants, full texts."""

from __future__ import annotations

from functools import lru_cache
from importlib.resources import files

_GNU = (
    "you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the "
    "Free Software Foundation{either} version {version} of the License, or (at your option) any later version."
)
_ONLY = (
    "you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the "
    "Free Software Foundation, version {version}."
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_NOTICE = "This work is licensed under the GNU {kind}, version {version}."
_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:"
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_BSD_END = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_CC = {
    "CC-BY-4.0": "Attribution",
    "CC-BY-SA-4.0": "Attribution-ShareAlike",
    "CC-BY-NC-4.0": "Attribution-NonCommercial",
    "CC-BY-ND-4.0": "Attribution-NoDerivatives",
    "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
}

# FIXED VALUES: headers and grants as the licenses themselves give them.
WORDINGS = [
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", _GRANT),
    (
        "MIT",
        _GRANT + " The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. " + _AS_IS,
    ),
    ("MIT", "This project is licensed under the MIT License."),
    *[
        (name, line.format(kind=kind, version=version, either=either))
        for name, kind, version in (
            ("GPL-2.0", _GPL, "2"),
            ("GPL-3.0", _GPL, "3"),
            ("LGPL-2.1", _LGPL, "2.1"),
            ("LGPL-3.0", _LGPL, "3"),
            ("AGPL-3.0", _AGPL, "3"),
        )
        for line, either in ((_GNU, "; either"), (_ONLY, ""))
    ],
    ("LGPL-2.1", _NOTICE.format(kind=_LGPL, version="2.1")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("EPL-1.0", "Licensed under the Eclipse Public License, version 1.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    *[
        (name, f"This work is licensed under a Creative Commons {kind} 4.0 International License.")
        for name, kind in _CC.items()
    ],
]


@lru_cache(maxsize=1)
def full_texts() -> list[tuple[str, str]]:
    """(license, its full text) of the files in ``licenses``."""
    found = sorted(files("stormgrid.llm").joinpath("licenses").iterdir(), key=lambda f: f.name)
    return [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in found if f.name.endswith(".txt")]
