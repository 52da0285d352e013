"""Entire licences: short ones as texts, long ones as digests of their canonical form.

The digests are of the files that Debian installs in ``/usr/share/common-licenses``: each whole, up to the end of its
terms, and with its links by http and https. They hold for :func:`tallyforge.llm.licenses.canonical` as it is and are
to be taken anew when that changes.
"""

from __future__ import annotations

BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:"
)
BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
)
BSD_NAME = (
    "Neither the name of {name} nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY {provider} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {liable} BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
    "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
    "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
    "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
    "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
    "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
    "relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
    '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <http://unlicense.org/>"
)
#: Who gives the software and who is not liable, as the usual BSD files have it.
BSD_PARTIES = (
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("THE REGENTS AND CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS"),
    ("THE AUTHOR AND CONTRIBUTORS", "THE AUTHOR OR CONTRIBUTORS"),
    ("THE AUTHORS AND CONTRIBUTORS", "THE AUTHORS OR CONTRIBUTORS"),
    ("THE AUTHOR", "THE AUTHOR"),
)
#: Who must not be named in advertising, in the third clause.
BSD_NAMES = ("the copyright holder", "the copyright holders", "the University", "the author")


def _bsd(clauses: tuple[str, ...], provider: str, liable: str, numbered: bool) -> str:
    listed = " ".join(f"{i}. {c}" if numbered else c for i, c in enumerate(clauses, 1))
    return f"{BSD_HEAD} {listed} {BSD_WARRANTY.format(provider=provider, liable=liable)}"


TEXTS = (
    *(("BSD-2-Clause", _bsd(BSD_CLAUSES, *parties, numbered)) for parties in BSD_PARTIES for numbered in (True, False)),
    *(("BSD-3-Clause", _bsd((*BSD_CLAUSES, BSD_NAME.format(name=name)), *parties, numbered)) for name in BSD_NAMES for parties in BSD_PARTIES for numbered in (True, False)),
    ("Unlicense", UNLICENSE),
    ("Unlicense", UNLICENSE.replace("http:", "https:")),
)
DIGESTS = (
    ("Apache-2.0", "0ba579ac9056affbca2df06f694522393c8af01f61e05f45bfaec0729908ca62"),
    ("Apache-2.0", "61a95724862a009deba4293a3fe0475119b554b5fcc7db47b41f93500e06624f"),
    ("Apache-2.0", "e22d90a7b514c175aef1c6dbbc279df96ab0634507cbc302ae2a9a9a1f383aff"),
    ("Apache-2.0", "eeba678493b5fa9a39f77c8f704f40313a406097b0138c22263c279148681457"),
    ("CC0-1.0", "1857a6817be463d903691bfa09d4f345ab7f4ed86a5db2a5966c03b160057e4a"),
    ("GFDL-1.2", "1dd1a849fa2dc97e0f44bcd0633120fb93af5b40e715825dfcc41c3c488b9ec7"),
    ("GFDL-1.2", "ecc9d73d27981e1847fadde8b5fc33380c966b8303b54725c87da872354c90f8"),
    ("GFDL-1.3", "e93338da049c89037e41eb3ba13486fe845f80bbd844d71b5401e1cbe95a278c"),
    ("GFDL-1.3", "f148d4624171c7c783ac40301fe48f5ed02e4b3a205d0e4fa348b4f180a7f371"),
    ("GPL-1.0", "b4583e68db0c858fa1b9028c689e3bddd78f836f274e963327fa158ec729531d"),
    ("GPL-1.0", "ed08c745e68ab20317aadafe6dce02ebd0c3144aae6150bedcbf106f5400b9f7"),
    ("GPL-2.0", "8ceef37851021afc07e4d5138e4c1c58b285e876796ca1a6cfa5eaa9ffaea599"),
    ("GPL-2.0", "c515d374612e244f9be2ed0f8f246e5b5a4263c22db143008cfc0e83dbd13fc2"),
    ("GPL-3.0", "5b47fb4fa4306dfd513a537be5379ff50a51808327ee482973c9ae57391d08bc"),
    ("GPL-3.0", "b4c42912d85182abb09e39f33b791d93201ac133838d0f9972b735a3e52acbff"),
    ("GPL-3.0", "bc8bb69aa8f949d94a3db853dcd0b0d9d1eae303796d5c80cb9fd5c6dab3ce1e"),
    ("LGPL-2.0", "f1f00c719b70f322454e249f66f757d50edc6aa692a8ed9f2b9dddfc7fc0aaad"),
    ("LGPL-2.0", "f917eb230a461b72c0d7845f5737ef74651abb0524547082a9645bc154d5ecd4"),
    ("LGPL-2.1", "06f44ebf9515e6c412985cf8f2c6b133e91f457a1f520a900164472a54c1dc58"),
    ("LGPL-2.1", "0e1fd8294d07a56f89328d57b6b461fc8a3a9170bb84d7d4613cf444dbfa34eb"),
    ("LGPL-3.0", "99c1a85dc9c673acfd6a330c4a68bd319185c3d6b8f4888157bf159e2ee60285"),
    ("MPL-1.1", "c7d627fafa44736c221fd95c0cc5823c5c9e362a39076a9f32b70dff239bef0f"),
    ("MPL-1.1", "d176bfd3156f073d3283de58e1c5628ad6c9f102a669c3045d85a6562794e0cf"),
    ("MPL-2.0", "9f24876fd9a65890ec6e960da23a85e71968c5fbfbb46fb0330255eadbff5067"),
    ("MPL-2.0", "d967acc6ac57ac0410b353c5ae5266cdc1affe6b50883a3da362e3028c5c1f19"),
)
