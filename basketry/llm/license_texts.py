"""Known licences: full texts and one-line notices, as published, and digests
of longer texts.

The texts are fixed values; case, line breaks, punctuation and the copyright
line do not matter (see ``licenses``)."""

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: (licence id, full text)
TEXTS = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_CONDITIONS + "\n" + _BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_CONDITIONS + "\n" + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_CONDITIONS + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_CONDITIONS + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_WARRANTY),
]

#: (licence id, one-line notice)
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("SPDX MIT", "SPDX-License-Identifier: MIT"),
    ("SPDX Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
]

#: (licence id, digest of the canonical form, what was hashed): files of
#: Debian's common licences, with and without the appendix behind the terms.
#: Another rule in ``licenses.RULES`` or spelling changes them.
DIGESTS = [
    ("Apache-2.0", "50cbb094474584269b5586f193c66e2ee1b13c5b32dbd2fad1148b344167b75f", "Apache-2.0"),
    ("Apache-2.0", "3a9588d0507842c7c1870987b9fc453727c5b577c622665c4909864c6614cf99", "Apache-2.0 up to END OF TERMS AND CONDITIONS"),
    ("Artistic-1.0-Perl", "add45fb0c4e9017cd77fe086c95cc762c4c71ce37e5ef6bfa3843bfa1b0eaa54", "Artistic"),
    ("BSD-3-Clause", "861d6bbeb1c7f30acb3e57a7c796efb4bab9c42558a095da06791509a80f4740", "BSD"),
    ("CC0-1.0", "857b6a70d6cb94c046df1a0655a3d4658f67942c47397c16835a095292216bc2", "CC0-1.0"),
    ("GFDL-1.2", "3bd72113fe46e04f5c1ad7be6a0f68fb2b5b8d2ea980834aa88b1d6168c52458", "GFDL-1.2"),
    ("GFDL-1.3", "356ed48552bfa74c002bfe257337bd72928f90a008204bc370496fd202745ed9", "GFDL-1.3"),
    ("GPL-1.0", "23da887c2bdd94a21e7c396cb5a958712ae46777cad89e050e5a62d9b0fd455b", "GPL-1"),
    ("GPL-1.0", "00a6ca8e4a899d101b1834979e5548510e230acaeff86fdd46fafc3196ef4a21", "GPL-1 up to END OF TERMS AND CONDITIONS"),
    ("GPL-2.0", "8e058a580148724a42a80e89ab1a8c786cd32be375989f885e9aa7b7a80f76c6", "GPL-2"),
    ("GPL-2.0", "92373decf4cb6d198b7dc6d68f84e3ea890242dbbc1be2f797aa8312a6b33b15", "GPL-2 up to END OF TERMS AND CONDITIONS"),
    ("GPL-3.0", "c36a7c4a716ad8ab064f9b0f88f4f3dd0a75157e29400a9d5b8c79acac896ad8", "GPL-3"),
    ("GPL-3.0", "9c2282aea3854a3d4f96088d8d53829be71e544824c4e20cb129ef47fbc64a46", "GPL-3 up to END OF TERMS AND CONDITIONS"),
    ("LGPL-2.0", "6d16f4ccfdebe792b655bfb8d134c6afe96eec0537c7815b8e5dc3ec9a633cf3", "LGPL-2"),
    ("LGPL-2.0", "6b18426589e2fbcf8149e4faced9808ef0cdb67ff904cc0c37771727c564ec6e", "LGPL-2 up to END OF TERMS AND CONDITIONS"),
    ("LGPL-2.1", "68e37b04887a00c84b37e2a307be478b3ea5d83f335aceea81f5691b9dde3d7f", "LGPL-2.1"),
    ("LGPL-2.1", "4dda0b9b190d2a042065e72b1d162a3e323274d38bc4435aef164e368b43cd51", "LGPL-2.1 up to END OF TERMS AND CONDITIONS"),
    ("LGPL-3.0", "f5d6d66d081f2b3c24069d432889f3412fc0f2718f31c1fdd432e247282b0ca1", "LGPL-3"),
    ("MPL-1.1", "03be5a557c8c9d79cb0508e77b3758916df5d236c522d7f7bae1fd5515e8c09e", "MPL-1.1"),
    ("MPL-2.0", "e5578a5c7c7259f70077f2825681c155569c556cb68c1dabebb9657b36f8701a", "MPL-2.0"),
    ("Artistic-2.0", "08d42040da96bb46e8c0fd000a81ebe2c9739ed7e0f2dafe52178892a63a4c02", "Artistic-2.0"),
]
