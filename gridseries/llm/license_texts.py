"""Public licence texts in full, without their copyright lines, by SPDX id.

Long texts are files of this folder's ``licenses``. A text that is often given with a heading, or with
"All rights reserved." on a line of its own, is known in each of these forms.
"""

from __future__ import annotations

from pathlib import Path

FILES = Path(__file__).with_name("licenses")

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so"
)
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "{one}Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "{two}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "{three}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_WTFPL = (
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
    "allowed as long as the name is changed.\n\n"
    "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nTERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n"
    "0. You just DO WHAT THE FUCK YOU WANT TO."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
    "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the "
    "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
    "all present and future rights to this software under copyright law.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _forms(spdx: str, text: str, *headings: str, reserved: bool = False) -> list[tuple[str, str]]:
    """The text as it stands and under each heading, each with and without the line on rights."""
    lines = ("", "All rights reserved.\n\n") if reserved else ("",)
    return [(spdx, (f"{h}\n\n" if h else "") + line + text) for h in ("", *headings) for line in lines]


def full_texts() -> list[tuple[str, str]]:
    out = _forms(
        "MIT",
        f"{_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
        f"included in all copies or substantial portions of the Software.\n\n{_WARRANTY}",
        "MIT License", "The MIT License", "The MIT License (MIT)",
        reserved=True,
    )
    out += _forms("MIT-0", f"{_GRANT}.\n\n{_WARRANTY}", "MIT No Attribution", "MIT-0", "MIT No Attribution License", reserved=True)
    out += _forms("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}", "ISC License", "The ISC License", "ISC License (ISC)")
    out += _forms("0BSD", f"{_ISC}.\n\n{_ISC_WARRANTY}", "BSD Zero Clause License", "Zero-Clause BSD", "0BSD")
    for one, two, three in (("", "", ""), ("1. ", "2. ", "3. ")):
        first = _BSD.format(one=one, two=two)
        out += _forms("BSD-2-Clause", first + _BSD_WARRANTY, "BSD 2-Clause License", "The BSD 2-Clause License", reserved=True)
        out += _forms("BSD-3-Clause", first + _BSD_NAMES.format(three=three) + _BSD_WARRANTY, "BSD 3-Clause License", "The BSD 3-Clause License", reserved=True)
    version = "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004"
    out += [("WTFPL", f"{version}\n\n{_WTFPL}"), ("WTFPL", _WTFPL)]
    for end in ("", "\n\nFor more information, please refer to <https://unlicense.org>", "\n\nFor more information, please refer to <https://unlicense.org/>", "\n\nFor more information, please refer to <http://unlicense.org/>"):
        out += _forms("Unlicense", _UNLICENSE + end, "The Unlicense")
    for path in sorted(FILES.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(path.stem, text)] + ([(path.stem, terms + end), (path.stem, terms)] if end else [])
    return out
