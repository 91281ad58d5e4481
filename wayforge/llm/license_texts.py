"""Public license texts and notices as templates; see license_scan for the markup."""

from __future__ import annotations

WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any 1 12>> BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<any 1 16>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any 1 16>>
BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<optional>>1<<end>> Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. <<optional>>2<<end>> Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution."""

NO_ENDORSEMENT = """<<optional>>3<<end>> Neither the name of <<any 1 16>> nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""

ISC_GRANT = "Permission to use, copy, modify, and<<optional>>/or<<end>> distribute this software for any purpose with or without fee is hereby granted"

ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND <<any 1 12>> <<match disclaim|disclaims>> ALL WARRANTIES WITH REGARD TO
THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<any 1 12>> BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

GNU = """This <<match program|library|file>> is free software<<optional>>:<<end>> you can redistribute it and/or modify it under
the terms of the GNU {name} General Public License as published by the Free Software Foundation<<optional>>,<<end>> either version
{version} of the License, or (at your option) any later version. <<optional>>This <<match program|library|file>> is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU {name} General Public License for more details.<<end>>"""

TEXTS = {
    "mit-text": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<optional>>
(including the next paragraph)<<end>> shall be included in all copies or substantial portions of the Software. {WARRANTY}""",
    "bsd-2-text": f"{BSD} {DISCLAIMER}",
    "bsd-3-text": f"{BSD} {NO_ENDORSEMENT} {DISCLAIMER}",
    "isc-text": f"{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {ISC_DISCLAIMER}",
    "0bsd-text": f"{ISC_GRANT}. {ISC_DISCLAIMER}",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event <<match will|shall>> <<any 1 8>>
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
<<optional>>1<<end>> The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an <<match acknowledgment|acknowledgement>> in the product documentation would be appreciated
but is not required. <<optional>>2<<end>> Altered source versions must be plainly marked as such, and must not be misrepresented as
being the original software. <<optional>>3<<end>> This notice may not be removed or altered from any source distribution.""",
    "unlicense-text": f"""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present
and future rights to this software under copyright law. {WARRANTY}""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at <<any 1 10>> Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-2-header": GNU.format(name="", version="2"),
    "gpl-3-header": GNU.format(name="", version="3"),
    "lgpl-header": GNU.format(name="<<match lesser|library>>", version="<<match 2|3>> <<optional>>1<<end>>"),
    "agpl-3-header": GNU.format(name="Affero", version="3"),
}
