"""Licence templates: (template id, SPDX id, text).

Fixed values: public notices and licence texts, without copyright lines.
"""

from __future__ import annotations

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

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

_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD3 = _BSD2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""

_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

TEMPLATES: list[tuple[str, str, str]] = [
    ("mit-text", "MIT", _MIT),
    ("mit-released", "MIT", "Released under the MIT License."),
    ("mit-licensed", "MIT", "Licensed under the MIT License."),
    ("mit-this", "MIT", "This project is licensed under the MIT License."),
    ("isc-text", "ISC", _ISC),
    ("bsd2-text", "BSD-2-Clause", _BSD2),
    ("bsd3-text", "BSD-3-Clause", _BSD3),
    ("bsd3-licensed", "BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("apache2-header", "Apache-2.0", _APACHE),
    ("apache2-licensed", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache2-this", "Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("gpl2-header", "GPL-2.0-or-later", _GPL.format(v="2")),
    ("gpl3-header", "GPL-3.0-or-later", _GPL.format(v="3")),
    ("gpl3-work", "GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl2-work", "GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("mpl2-header", "MPL-2.0", _MPL),
    ("unlicense-text", "Unlicense", _UNLICENSE),
    ("cc-by-4", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4-work", "CC-BY-4.0",
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4-work", "CC-BY-SA-4.0",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-work", "CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain."),
]
