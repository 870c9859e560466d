"""Known licences: whole texts and one-line notices (fixed values, in SPDX order)."""

from importlib import resources

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_BSD_START = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""

_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
"""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted{condition}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""


def _file(license_id: str) -> str:
    return resources.files(__package__).joinpath("license_files", f"{license_id}.txt").read_text("utf-8")


def _forms(license_id: str) -> list[tuple[str, str]]:
    """A long text as it is handed on: whole, without the appendix on how to apply it, and with its place for a name filled in."""
    text = _file(license_id)
    forms = [text]
    if _END in text:
        terms = text[:text.index(_END)]
        forms += [terms + _END, terms]
    if _PLACE in text:
        forms.append(text.replace(_PLACE, ""))  # a copyright line that is filled in is no part of a canonical text
    return [(license_id, t) for t in forms]


_END, _PLACE = "END OF TERMS AND CONDITIONS", "Copyright [yyyy] [name of copyright owner]"
#: Licences whose text is a file of license_files/.
FILES = ["Apache-2.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"]

#: (licence, whole text)
TEXTS = [
    ("0BSD", _ISC_GRANT.format(condition="")),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("ISC", _ISC_GRANT.format(condition=", provided that the above\ncopyright notice and this permission notice appear in all copies")),
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    *(form for i in FILES for form in _forms(i)),
]

#: (licence, kind, names it goes by in notices)
NAMES = [
    ("AGPL-3.0", "copyleft", ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"]),
    ("Apache-2.0", "permissive", ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license", "Apache 2.0 license"]),
    ("BSD-2-Clause", "permissive", ["BSD 2-Clause License", "Simplified BSD License"]),
    ("BSD-3-Clause", "permissive", ["BSD 3-Clause License", "New BSD License"]),
    ("CC-BY-4.0", "permissive", ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]),
    ("CC-BY-NC-4.0", "noncommercial", ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]),
    ("CC-BY-SA-4.0", "copyleft", ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("CC0-1.0", "permissive", ["CC0 1.0", "CC0 1.0 Universal"]),
    ("GPL-2.0", "copyleft", ["GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0 license"]),
    ("GPL-3.0", "copyleft", ["GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0 license"]),
    ("ISC", "permissive", ["ISC License"]),
    ("LGPL-3.0", "copyleft", ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0 license"]),
    ("MIT", "permissive", ["MIT License"]),
    ("MPL-2.0", "copyleft", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"]),
]

#: What stands before a name in a notice.
OPENINGS = ["Licensed under", "Licensed under the", "Released under", "Released under the", "Distributed under the",
            "This work is licensed under", "This work is licensed under the", "This software is licensed under the",
            "This project is licensed under the", "This file is licensed under the", "Available under the"]

#: Notices that name no licence.
OTHER_NOTICES = [("all-rights-reserved", "reserved", "All rights reserved.")]

#: (licence, kind, lines of its standard header). Where the header is wrapped before the version, the line names the family only.
HEADERS = [
    ("AGPL-3.0", "copyleft", ["it under the terms of the GNU Affero General Public License as published by",
                              "it under the terms of the GNU Affero General Public License as published"]),
    ("Apache-2.0", "permissive", ['Licensed under the Apache License, Version 2.0 (the "License");',
                                  'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.']),
    ("CC-BY-4.0", "permissive", ["This work is licensed under a Creative Commons Attribution 4.0 International License."]),
    ("CC-BY-NC-4.0", "noncommercial", ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]),
    ("CC-BY-SA-4.0", "copyleft", ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."]),
    ("GPL", "copyleft", ["it under the terms of the GNU General Public License as published by",
                         "under the terms of the GNU General Public License as published by the Free"]),
    ("GPL-2.0", "copyleft", ["it under the terms of the GNU General Public License version 2 as"]),
    ("GPL-3.0", "copyleft", ["it under the terms of the GNU General Public License version 3 as"]),
    ("LGPL", "copyleft", ["it under the terms of the GNU Lesser General Public License as published by",
                          "modify it under the terms of the GNU Lesser General Public"]),
    ("MPL-2.0", "copyleft", ["License, v. 2.0. If a copy of the MPL was not distributed with this",
                             "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."]),
]

#: Licences whose SPDX identifier says if later versions count too.
VERSIONED = ["AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0"]
