"""Fixed values of the license scan: phrases of the contract, wording of public licenses and of notices that name them.

``<<beginOptional>> ... <<endOptional>>`` may be left out, ``<<var;min=0;max=8>>`` stands for any few words, and all other
wording is mandatory. Whole licenses and headers begin and end with their own first and last words.
"""

from __future__ import annotations

#: Fixed values of the contract: phrase and label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Words that make a notice behind them no grant.
NEGATIONS = ("not", "never", "neither", "nor", "cannot", "without", "isn", "aren", "wasn")

_MIT_DISCLAIMER = """
the <<var;min=1;max=4>> is provided "as is", without warranty of any kind, express or implied, including but not limited to the
warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall the
<<var;min=1;max=8>> be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,
arising from, out of or in connection with the <<var;min=1;max=4>> or the use or other dealings in the <<var;min=1;max=4>>"""

_BSD_CONDITIONS = """
redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: <<var;min=0;max=1>> redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. <<var;min=0;max=1>> redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. <<var;min=0;max=1>>"""

_BSD_DISCLAIMER = """
this software is provided by <<var;min=1;max=12>> "as is" and any express or implied warranties, including, but not limited to,
the implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall
<<var;min=1;max=12>> be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including,
but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption)
however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or
otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage"""


def _gnu(name: str, version: str) -> str:
    return f"""
this <<var;min=1;max=3>> is free software: you can redistribute it and/or modify it under the terms of the gnu {name} as published
by the free software foundation, either version {version} of the license, or (at your option) any later version. this
<<var;min=1;max=3>> is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty
of merchantability or fitness for a particular purpose. see the gnu {name} for more details. you should have received a copy of the
gnu {name} along with this <<var;min=1;max=3>> <<beginOptional>>if not, see <<var;min=1;max=8>><<endOptional>>"""


#: Whole licenses, and the headers that their authors ask for.
TEXTS = {
    "mit-text": """
permission is hereby granted, free of charge, to any person obtaining a copy of this <<var;min=1;max=4>> and associated
documentation files (the <<var;min=1;max=4>>), to deal in the <<var;min=1;max=4>> without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
<<var;min=1;max=4>>, and to permit persons to whom the <<var;min=1;max=4>> is furnished to do so, subject to the following
conditions: the above copyright notice and this permission notice <<beginOptional>>(including the next
paragraph)<<endOptional>> shall be included in all copies or substantial portions of the <<var;min=1;max=4>>. """
    + _MIT_DISCLAIMER,
    "bsd-2-clause-text": _BSD_CONDITIONS + _BSD_DISCLAIMER,
    "bsd-3-clause-text": _BSD_CONDITIONS
    + """ neither the name of <<var;min=1;max=10>> nor the names of <<var;min=1;max=4>> may be used to endorse or promote products
derived from this software without specific prior written permission. """
    + _BSD_DISCLAIMER,
    "isc-text": """
permission to use, copy, modify, <<beginOptional>>and<<endOptional>> <<beginOptional>>or<<endOptional>> distribute this
<<var;min=1;max=3>> for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies. the <<var;min=1;max=3>> is provided "as is" and <<var;min=1;max=6>> disclaims all
warranties with regard to this <<var;min=1;max=3>> including all implied warranties of merchantability and fitness. in no event
shall <<var;min=1;max=6>> be liable for any special, direct, indirect, or consequential damages or any damages whatsoever
resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising
out of or in connection with the use or performance of this <<var;min=1;max=3>>""",
    "zlib-text": """
this software is provided 'as-is', without any express or implied warranty. in no event will the authors be held liable for any
damages arising from the use of this software. permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
<<var;min=0;max=1>> the origin of this software must not be misrepresented; you must not claim that you wrote the original
software. if you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required. <<var;min=0;max=1>> altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. <<var;min=0;max=1>> this notice may not be removed or altered from any source distribution""",
    "unlicense-text": """
this is free and unencumbered software released into the public domain. anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. in jurisdictions that recognize copyright laws, the author or authors of this software dedicate
any and all copyright interest in the software to the public domain. we make this dedication for the benefit of the public at
large and to the detriment of our heirs and successors. we intend this dedication to be an overt act of relinquishment in
perpetuity of all present and future rights to this software under copyright law. """
    + _MIT_DISCLAIMER,
    "apache-2.0-header": """
licensed under the apache license, version 2.0 <<beginOptional>>(the "license")<<endOptional>>; you may not use this
<<var;min=1;max=3>> except in compliance with the license. you may obtain a copy of the license at <<var;min=1;max=10>> unless
required by applicable law or agreed to in writing, <<var;min=1;max=3>> distributed under the license is distributed on an "as
is" basis, without warranties or conditions of any kind, either express or implied. see the license for the specific language
governing permissions and limitations under the license""",
    "gpl-2.0-header": _gnu("general public license", "2"),
    "gpl-3.0-header": _gnu("general public license", "3"),
    "lgpl-2.1-header": _gnu("lesser general public license", "2.1"),
    "lgpl-3.0-header": _gnu("lesser general public license", "3"),
    "agpl-3.0-header": _gnu("affero general public license", "3"),
}

_TERMS = "<<beginOptional>>the terms of<<endOptional>>"
#: What a notice names behind "licensed under", "released under" and the like.
_NAMED = {
    "mit-notice": "<<beginOptional>>the<<endOptional>> mit license",
    "apache-2.0": "<<beginOptional>>the<<endOptional>> apache license <<beginOptional>>version<<endOptional>> 2.0",
    "gpl-2.0": "<<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version 2",
    "gpl-3.0": "<<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version 3",
    "lgpl-notice": "<<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>> lesser general public license",
    "agpl-notice": "<<beginOptional>>the<<endOptional>> <<beginOptional>>gnu<<endOptional>> affero general public license",
    "cc-by-4.0": "<<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by 4.0",
    "cc-by-nc-4.0": "<<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by nc 4.0",
    "cc-by-sa-4.0": "<<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by sa 4.0",
}
#: Notices: a verb of granting and the license.
NOTICES = {label: [f"{verb} under {_TERMS} {named}" for verb in ("licensed", "released", "distributed", "available", "published")] for label, named in _NAMED.items()}
