"""Templates of the licence scan: public licence notices and texts, by label.

Braces mark phrases that a text must have in one piece for the label: they tell a template from its near relatives.
Families of notices that differ in a name or a version are made by rule.
"""

from __future__ import annotations

from collections.abc import Iterator

# Phrases and labels of the base rules.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Public licence notices and texts, or parts of them, by label.
TEXTS = (
    ("mit", "Released under the {MIT License}."),
    ("mit", "Licensed under the {MIT license}."),
    ("mit", "This project is licensed under the terms of the {MIT license}."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software.""",
    ),
    (
        "mit",
        """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND {NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS} OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, {and/or distribute this software} for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "isc",
        """THE SOFTWARE IS PROVIDED "AS IS" AND {THE AUTHOR DISCLAIMS ALL WARRANTIES} WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("apache-2", "Licensed under the {Apache License, Version 2.0}."),
    ("apache-2", "This project is licensed under the {Apache License 2.0}."),
    (
        "apache-2",
        """Licensed under the {Apache License, Version 2.0} (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    (
        "apache-2",
        """Grant of Copyright License. Subject to the terms and conditions of this License, {each Contributor hereby grants to You} a
        perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare
        Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works
        in Source or Object form.""",
    ),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    (
        "bsd-3-clause",
        """{Neither the name of} the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission.""",
    ),
    (
        "bsd-2-clause",
        """THIS SOFTWARE IS PROVIDED BY THE {COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"} AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
        NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
        SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
        OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
    ),
    ("gpl-3", "The {GNU General Public License is a free, copyleft license} for software and other kinds of works."),
    (
        "gpl-2",
        """The licenses for most software are designed to take away your freedom to share and change it. By contrast, the {GNU General
        Public License is intended to guarantee} your freedom to share and change free software to make sure the software is free for
        all its users.""",
    ),
    (
        "agpl-3",
        """The {GNU Affero General Public License is a free, copyleft license} for software and other kinds of works, specifically
        designed to ensure cooperation with the community in the case of network server software.""",
    ),
    (
        "lgpl-3",
        """This version of the {GNU Lesser General Public License incorporates} the terms and conditions of version 3 of the GNU General
        Public License, supplemented by the additional permissions listed below.""",
    ),
    (
        "mpl-2",
        """This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    ("mpl-2", "Licensed under the {Mozilla Public License 2.0}."),
    (
        "epl-2",
        """This program and the accompanying materials are made available under the terms of the {Eclipse Public License 2.0} which is
        available at https://www.eclipse.org/legal/epl-2.0""",
    ),
    (
        "epl-1",
        """This program and the accompanying materials are made available under the terms of the {Eclipse Public License v1.0} which
        accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html""",
    ),
    (
        "artistic-2",
        """This license establishes the terms under which a given free software {Package may be copied, modified, distributed}, and/or
        redistributed. The intent is that the Copyright Holder maintains some artistic control over the development of that
        Package while still keeping the Package available as open source and free software.""",
    ),
    ("artistic-2", "This program is free software; you can redistribute it and/or modify it under the terms of the {Artistic License 2.0}."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "unlicense",
        """Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
        as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
        any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to {alter it and redistribute it freely}, subject to the following
        restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software.""",
    ),
    (
        "bsl-1",
        """Permission is hereby granted, free of charge, to any {person or organization obtaining a copy} of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
        Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished
        to do so""",
    ),
    ("bsl-1", "Distributed under the {Boost Software License, Version 1.0}."),
    (
        "gpl-3",
        """"This License" refers to {version 3 of the GNU General Public License}. "Copyright" also means copyright-like laws that apply to
        other kinds of works, such as semiconductor masks. "The Program" refers to any copyrightable work licensed under this License.
        Each licensee is addressed as "you". "Licensees" and "recipients" may be individuals or organizations.""",
    ),
    (
        "agpl-3",
        """"This License" refers to {version 3 of the GNU Affero General Public License}. "Copyright" also means copyright-like laws that
        apply to other kinds of works, such as semiconductor masks. "The Program" refers to any copyrightable work licensed under this
        License. Each licensee is addressed as "you". "Licensees" and "recipients" may be individuals or organizations.""",
    ),
    (
        "gpl-2",
        """This License applies to any program or other work which contains a notice placed by the copyright holder saying it may be
        distributed under the terms of {this General Public License}. The "Program", below, refers to any such program or work, and a
        "work based on the Program" means either the Program or any derivative work under copyright law""",
    ),
    (
        "0bsd",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is {hereby granted. THE
        SOFTWARE IS PROVIDED "AS IS"} AND THE AUTHOR DISCLAIMS ALL WARRANTIES""",
    ),
    ("apache-1.1", "{The Apache Software License, Version 1.1}"),
    (
        "apache-1.1",
        """The end-user documentation included with the redistribution, if any, must include the following acknowledgment: "This
        product includes software {developed by the Apache Software Foundation} (http://www.apache.org/)." Alternately, this
        acknowledgment may appear in the software itself, if and wherever such third-party acknowledgments normally appear.""",
    ),
    (
        "wtfpl",
        """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is
        allowed {as long as the name is changed}.""",
    ),
    ("wtfpl", "{DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE}"),
    (
        "x11",
        """Except as contained in this notice, the name of the X Consortium {shall not be used in advertising} or otherwise to promote the
        sale, use or other dealings in this Software without prior written authorization from the X Consortium.""",
    ),
    ("cc0", "{creativecommons.org/publicdomain/zero/1.0}"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

# Names and versions of the GNU licences, and the word for what they cover.
GNU = (
    ("gpl", "General Public License", "program", ("2", "3")),
    ("lgpl", "Lesser General Public License", "library", ("2.1", "3")),
    ("agpl", "Affero General Public License", "program", ("3",)),
)
# The heads of their texts.
GNU_HEADS = (
    ("gpl-2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"), ("gpl-3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"), ("lgpl-3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("agpl-3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
)
# Licences whose texts hold most of another's: where both are found close together, the other is not meant.
RELATIVES = (("bsd-3-clause", "bsd-2-clause"), ("apache-1.1", "bsd-2-clause"), ("apache-1.1", "bsd-3-clause"), ("x11", "mit"), ("0bsd", "isc"))
# Codes and names of the Creative Commons licences, and names of their versions.
CC = (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
CC_VERSIONS = (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
# Identifiers of the SPDX list, by label.
SPDX = (
    ("mit", "MIT"), ("isc", "ISC"), ("zlib", "Zlib"), ("bsl-1", "BSL-1.0"), ("apache-2", "Apache-2.0"), ("bsd-2-clause", "BSD-2-Clause"),
    ("bsd-3-clause", "BSD-3-Clause"), ("gpl-2", "GPL-2.0"), ("gpl-3", "GPL-3.0"), ("lgpl-2.1", "LGPL-2.1"), ("lgpl-3", "LGPL-3.0"),
    ("agpl-3", "AGPL-3.0"), ("mpl-2", "MPL-2.0"), ("epl-1", "EPL-1.0"), ("epl-2", "EPL-2.0"), ("artistic-2", "Artistic-2.0"),
    ("unlicense", "Unlicense"), ("cc0", "CC0-1.0"), ("0bsd", "0BSD"), ("apache-1.1", "Apache-1.1"), ("wtfpl", "WTFPL"), ("x11", "X11"),
)


def _gnu() -> Iterator[tuple[str, str]]:
    for label, name, what, versions in GNU:
        for v in versions:
            own = f"{label}-{v}"
            yield own, f"This work is licensed under the {{GNU {name}, version {v}}}."
            yield own, f"Licensed under the {{GNU {name} v{v}}}"
            yield own, f"Licensed under the {{GNU {name} v{v}.0}}"
            yield (
                own,
                f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the {{GNU {name}}} as published by
                the Free Software Foundation, either {{version {v} of the License}}, or (at your option) any later version.""",
            )


def _cc() -> Iterator[tuple[str, str]]:
    for code, name in CC:
        own = f"cc-{code.lower()}"
        for v, kind in CC_VERSIONS:
            yield own, f"Licensed under {{CC {code} {v}}}."
            yield own, f"This work is licensed under a {{Creative Commons {name} {v}}} {kind} License."
            yield own, f"{{creativecommons.org/licenses/{code.lower()}/{v}}}"


def identifiers() -> list[tuple[str, str]]:
    """(label, identifier) as they stand in expressions such as "MIT OR Apache-2.0"."""
    return [*SPDX, *((f"cc-{code.lower()}", f"CC-{code}-{v}") for code, _ in CC for v, _ in CC_VERSIONS)]


def templates() -> list[tuple[str, str]]:
    """(label, text) of all templates."""
    heads = ((label, f"{{{head}}}") for label, head in GNU_HEADS)
    return [*TEXTS, *_gnu(), *heads, *_cc(), *((label, f"{{SPDX-License-Identifier: {name}}}") for label, name in identifiers())]
