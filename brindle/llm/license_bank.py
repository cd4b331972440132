"""The templates of the registered license scan: full texts, standard headers and the ways to cite a license.

Names are SPDX identifiers; what follows a ``#`` tells wordings of one license apart.
"""

from __future__ import annotations

import re
from importlib import resources

_GNU = """{0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License
as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."""
_WARRANTY = """{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details."""

#: Standard headers of source files.
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
} | {
    f"{name}#{k}": text
    for name, what, kind, version in (
        ("GPL-2.0", "This program", "", "2"),
        ("GPL-3.0", "This program", "", "3"),
        ("LGPL-2.1", "This library", "Lesser ", "2.1"),
        ("LGPL-3.0", "This library", "Lesser ", "3"),
        ("AGPL-3.0", "This program", "Affero ", "3"),
    )
    for k, text in enumerate((_GNU.format(what, kind, version), _GNU.format(what, kind, version) + " " + _WARRANTY.format(what, kind)))
}


def _versions(long: str, short: str, version: str) -> list[str]:
    forms = [f"{long} {v}" for v in (version, f"version {version}", f"v {version}", f"v{version}")]
    return [*forms, f"version {version} of the {long}", f"{short} {version}", f"{short} version {version}", f"{short} v{version}"]


#: Names under which notices cite a license.
CITED = {
    "0BSD": ["Zero-Clause BSD License", "0BSD License", "BSD Zero Clause License"],
    "AGPL-3.0": _versions("GNU Affero General Public License", "GNU AGPL", "3") + ["AGPL 3", "AGPL v3", "AGPL version 3", "AGPLv3"],
    "Apache-2.0": _versions("Apache License", "Apache", "2.0") + _versions("Apache Software License", "ASL", "2.0") + ["Apache 2 License", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License", "two-clause BSD license"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "three-clause BSD license"],
    "BSL-1.0": _versions("Boost Software License", "BSL", "1.0"),
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0", "Creative Commons CC0 1.0"],
    "GPL-2.0": _versions("GNU General Public License", "GNU GPL", "2") + ["GPL 2", "GPL v2", "GPL version 2", "GPLv2"],
    "GPL-3.0": _versions("GNU General Public License", "GNU GPL", "3") + ["GPL 3", "GPL v3", "GPL version 3", "GPLv3"],
    "ISC": ["ISC License", "ISC licence"],
    "LGPL-2.1": _versions("GNU Lesser General Public License", "GNU LGPL", "2.1") + ["LGPL 2.1", "LGPL v2.1", "LGPL version 2.1", "LGPLv2.1"],
    "LGPL-3.0": _versions("GNU Lesser General Public License", "GNU LGPL", "3") + ["LGPL 3", "LGPL v3", "LGPL version 3", "LGPLv3"],
    "MIT": ["MIT License", "MIT licence", "MIT open source license", "Expat License", "MIT X11 license"],
    "MPL-2.0": _versions("Mozilla Public License", "MPL", "2.0"),
    "Unlicense": ["Unlicense license", "the Unlicense"],
    "Zlib": ["zlib License", "zlib libpng License"],
} | {
    f"CC-{code.upper().replace(' ', '-')}-4.0": [f"CC {code} 4.0", f"CC-{code}-4.0 license", f"Creative Commons {name} 4.0", f"Creative Commons {name} 4.0 International"]
    for code, name in (
        ("BY", "Attribution"),
        ("BY-SA", "Attribution-ShareAlike"),
        ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    )
}
#: Names that stand for a license where something says that it is meant.
SHORT = {"0BSD": ["0BSD"], "CC0-1.0": ["CC0"], "ISC": ["ISC"], "MIT": ["MIT", "Expat"], "Unlicense": ["Unlicense"], "Zlib": ["zlib"]}
_SAID = ("{} licensed", "{} style license", "licensed under {}", "licensed under the {}", "license is {}", "license identifier {}")

_WORD = re.compile(r"[0-9a-z]+")


def citations(name: str) -> list[str]:
    """Wordings that cite the license, of any number of words, less those that hold another."""
    made = set(CITED.get(name, ())) | {said.format(n) for n in SHORT.get(name, ()) for said in _SAID} | {f"license identifier {name}"}
    made = {" ".join(_WORD.findall(x.lower())) for x in made}
    made = {y for x in made for y in ([x] if " " in x else [f"under {x}", f"under the {x}", f"{x} license", f"{x} licensed", f"license {x}"])}
    least: list[str] = []
    for x in sorted(made, key=lambda x: (len(x.split()), x)):
        if not any(f" {y} " in f" {x} " for y in least):
            least.append(x)
    return least


def bank() -> dict[str, str]:
    """Every template by name."""
    folder = resources.files("brindle.llm") / "license_texts"
    out = {f"{f.name.removesuffix('.txt')}#text": f.read_text(encoding="utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    out |= {k.replace("#", "#header") if "#" in k else f"{k}#header": t for k, t in HEADERS.items()}
    out |= {f"{name}#citation{k}": t for name in CITED for k, t in enumerate(citations(name))}
    return dict(sorted(out.items()))
