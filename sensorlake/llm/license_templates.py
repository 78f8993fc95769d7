"""Texts of public licences and of the notices that name them.

Long licences stand with their opening: the title and the first paragraph,
which no other text shares.  All entries are fixed values.
"""

from __future__ import annotations

_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_LIABILITY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_TERMS = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted"
)
_ISC_LIABILITY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
    "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
    "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_VERBATIM = (
    "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
    "allowed. "
)


def _gnu_notice(work: str, name: str, version: str) -> str:
    return (
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        f"later version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} "
        f"for more details. You should have received a copy of the {name} along with this {work}. If not, see "
        f"https://www.gnu.org/licenses/."
    )


TEMPLATES = {
    "0BSD": f"{_ISC_TERMS}. {_ISC_LIABILITY}",
    "AGPL-3.0 notice": _gnu_notice("program", "GNU Affero General Public License", "3"),
    "AGPL-3.0 text": (
        f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 {_VERBATIM} Preamble The GNU Affero General "
        "Public License is a free, copyleft license for software and other kinds of works, specifically designed to "
        "ensure cooperation with the community in the case of network server software."
    ),
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "Apache-2.0 text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, "
        "reproduction, and distribution as defined by Sections 1 through 9 of this document."
    ),
    "BSD line": "Licensed under the BSD License.",
    "BSD-2-Clause": _BSD_TERMS + _BSD_LIABILITY,
    "BSD-3-Clause": _BSD_TERMS + _BSD_NAMES + _BSD_LIABILITY,
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following:"
    ),
    "CC-BY short line": "Licensed under CC BY 4.0.",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC short line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA short line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0 line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0 notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "CC0-1.0 text": (
        "Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive "
        "Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an "
        "\"owner\") of an original work of authorship and/or a database (each, a \"Work\")."
    ),
    "GPL notice": _gnu_notice("program", "GNU General Public License", "3"),
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 text": (
        f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 {_VERBATIM} Preamble The licenses for most software are "
        "designed to take away your freedom to share and change it. By contrast, the GNU General Public License is "
        "intended to guarantee your freedom to share and change free software--to make sure the software is free for "
        "all its users."
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 text": (
        f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_VERBATIM} Preamble The GNU General Public License is a "
        "free, copyleft license for software and other kinds of works."
    ),
    "ISC": (
        f"{_ISC_TERMS}, provided that the above copyright notice and this permission notice appear in all copies. "
        f"{_ISC_LIABILITY}"
    ),
    "LGPL notice": _gnu_notice("library", "GNU Lesser General Public License", "2.1"),
    "LGPL-2.1 text": (
        f"GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 {_VERBATIM} [This is the first released version "
        "of the Lesser GPL. It also counts as the successor of the GNU Library Public License, version 2, hence the "
        "version number 2.1.]"
    ),
    "LGPL-3.0 text": (
        f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_VERBATIM} This version of the GNU Lesser General "
        "Public License incorporates the terms and conditions of version 3 of the GNU General Public License, "
        "supplemented by the additional permissions listed below."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT line": "Released under the MIT License.",
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "MPL-2.0 text": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity "
        "that creates, contributes to the creation of, or owns Covered Software."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution."
    ),
}

# Short identifiers as they stand behind "SPDX-License-Identifier:".
IDENTIFIERS = (
    "0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 EPL-2.0 GPL-2.0 "
    "GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense Zlib"
).split()
TEMPLATES |= {f"{i} identifier": f"SPDX-License-Identifier: {i}" for i in IDENTIFIERS}
