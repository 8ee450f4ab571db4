"""Known licences, as texts to match whole. Further ones are passed to the scan as a table."""

from __future__ import annotations

import pkgutil

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

_ADDRESSES = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "675 Mass Ave, Cambridge, MA 02139, USA",
)


def _gnu_headers(name: str, version: str, thing: str = "program") -> list[str]:
    """The header for source files, for this version only or any later one, with each way of getting a copy."""
    later = f"either version {version} of the License, or (at your option) any later version."
    copies = ["see <http://www.gnu.org/licenses/>.", *[f"write to the Free Software Foundation, Inc., {a}." for a in _ADDRESSES]]
    return [
        f"""This {thing} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by
        the Free Software Foundation; {terms}

        This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

        You should have received a copy of the {name} along with this {thing}; if not, {copy}"""
        for terms in (later, f"version {version} of the License.", f"version {version}.")
        for copy in copies
    ]


def _full(name: str, cut: str | None = None) -> list[str]:
    """A whole public text from ``licenses/``, with and without what follows its terms."""
    whole = pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()
    texts = [whole, whole.replace("Copyright [yyyy] [name of copyright owner]", "")]
    if cut:
        terms = whole[: whole.index(cut)]
        texts += [terms, terms.replace("END OF TERMS AND CONDITIONS", "")]
    return list(dict.fromkeys(t.replace(_ADDRESSES[0], a) for t in texts for a in _ADDRESSES))


# Public licence texts and notices. (licence, kind, text)
KNOWN: tuple[tuple[str, str, str], ...] = (
    ("MIT", "permissive", _MIT_GRANT),
    ("MIT", "permissive", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "permissive", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "Licensed under the MIT License."),
    ("ISC", "permissive", _ISC),
    ("ISC", "permissive", "ISC License\n\n" + _ISC),
    ("Zlib", "permissive", _ZLIB),
    ("Zlib", "permissive", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "permissive", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "permissive", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "permissive", "Released under CC0 1.0."),
    ("MPL-2.0", "copyleft", "Licensed under the Mozilla Public License, Version 2.0."),
    ("GPL-2.0", "copyleft", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "copyleft", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "restricted", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "restricted", "Licensed under CC BY-ND 4.0."),
    ("LicenseRef-All-Rights-Reserved", "restricted", "All rights reserved."),
    *[
        (name, "permissive", before + _BSD_GRANT + names + _BSD_END)
        for name, names, titles in (
            ("BSD-2-Clause", "", ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License')),
            ("BSD-3-Clause", _BSD_NAMES, ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License')),
        )
        for title in ("", *[t + "\n\n" for t in titles])
        for before in (title, title + "All rights reserved.\n\n")
    ],
    ("Apache-2.0", "permissive", _APACHE_HEADER),
    ("MPL-2.0", "copyleft", _MPL_HEADER),
    *[("GPL-2.0", "copyleft", t) for t in _gnu_headers("GNU General Public License", "2")],
    *[("GPL-3.0", "copyleft", t) for t in _gnu_headers("GNU General Public License", "3")],
    *[("AGPL-3.0", "copyleft", t) for t in _gnu_headers("GNU Affero General Public License", "3")],
    *[("LGPL-2.1", "copyleft", t) for t in _gnu_headers("GNU Lesser General Public License", "2.1", "library")],
    *[("LGPL-3.0", "copyleft", t) for t in _gnu_headers("GNU Lesser General Public License", "3", "library")],
    *[("Apache-2.0", "permissive", t) for t in _full("Apache-2.0", "APPENDIX: How to apply")],
    *[("GPL-2.0", "copyleft", t) for t in _full("GPL-2", "How to Apply These Terms to Your New Programs")],
    *[("GPL-3.0", "copyleft", t) for t in _full("GPL-3", "How to Apply These Terms to Your New Programs")],
    *[("LGPL-2.0", "copyleft", t) for t in _full("LGPL-2", "How to Apply These Terms to Your New Libraries")],
    *[("LGPL-2.1", "copyleft", t) for t in _full("LGPL-2.1", "How to Apply These Terms to Your New Libraries")],
    *[("LGPL-3.0", "copyleft", t) for t in _full("LGPL-3")],
    *[("MPL-1.1", "copyleft", t) for t in _full("MPL-1.1")],
    *[("MPL-2.0", "copyleft", t) for t in _full("MPL-2.0", "Exhibit A - Source Code Form License Notice")],
    *[("CC0-1.0", "permissive", t) for t in _full("CC0-1.0")],
)

# Spellings that mean the same, as in the public guidelines for matching licences.
EQUIVALENT: dict[str, str] = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "favour": "favor",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "licencing": "licensing",
    "modelled": "modeled",
    "optimisation": "optimization",
    "organisation": "organization",
    "practise": "practice",
    "programme": "program",
    "recognise": "recognize",
    "rightsholder": "rightholder",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "v2": "2",
    "v3": "3",
}
