"""Signature rules of the license scan: regexes over lower-cased words set apart by one blank.

A rule has a keyword that any text it matches contains, a regex, a label, a
priority and a confidence. Most rules come from the families below: each
name and version gives a bare-name rule, a versioned rule, a notice ("licensed
under the ...") and an identifier rule; so do the short names, where the GNU
licenses also have "only" and "or later", the latter by a "+" too, which the scan leaves at
the end of a version (it is part of no word elsewhere). The rest are sentences of the
licenses' own texts, of file headers and of notices, each written by hand.
"""

from __future__ import annotations

from dataclasses import dataclass

# License families as label, keyword, name (regex), versions.
FAMILIES = [
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e", ["1", "3"]),
    ("lgpl", "general public", "(?:gnu )?(?:lesser|library) general public licen[cs]e", ["2", "2 1", "3"]),
    ("gpl", "general public", "(?:gnu )?general public licen[cs]e", ["1", "2", "3"]),
    ("gfdl", "free documentation", "(?:gnu )?free documentation licen[cs]e", ["1 1", "1 2", "1 3"]),
    ("apache", "apache", "apache (?:software )?licen[cs]e", ["1 0", "1 1", "2 0"]),
    ("mit", "mit ", "(?:the )?(?:mit|expat) licen[cs]e", []),
    ("mpl", "mozilla", "mozilla public licen[cs]e", ["1 0", "1 1", "2 0"]),
    ("npl", "netscape", "netscape public licen[cs]e", ["1 0", "1 1"]),
    ("epl", "eclipse", "eclipse public licen[cs]e", ["1 0", "2 0"]),
    ("edl", "eclipse", "eclipse distribution licen[cs]e", ["1 0"]),
    ("cddl", "common development", "common development and distribution licen[cs]e", ["1 0", "1 1"]),
    ("cpl", "common public", "common public licen[cs]e", ["1 0"]),
    ("cpal", "common public attribution", "common public attribution licen[cs]e", ["1 0"]),
    ("ipl", "ibm public", "ibm public licen[cs]e", ["1 0"]),
    ("lpl", "lucent", "lucent public licen[cs]e", ["1 0", "1 02"]),
    ("spl", "sun public", "sun public licen[cs]e", ["1 0"]),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", []),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", []),
    ("artistic", "artistic", "(?:clarified )?artistic licen[cs]e", ["1 0", "2 0"]),
    ("bsl", "boost", "boost software licen[cs]e", ["1 0"]),
    ("busl", "business source", "business source licen[cs]e", ["1 0", "1 1"]),
    ("eupl", "european union", "european union public licen[cs]e", ["1 0", "1 1", "1 2"]),
    ("osl", "open software", "open software licen[cs]e", ["1 0", "1 1", "2 0", "2 1", "3 0"]),
    ("afl", "academic free", "academic free licen[cs]e", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("cecill", "cecill", "cecill(?: free software)?(?: licen[cs]e)?", ["1 0", "1 1", "2 0", "2 1"]),
    ("ofl", "open font", "(?:sil )?open font licen[cs]e", ["1 0", "1 1"]),
    ("wtfpl", "wtf", "(?:wtfpl|wtf public licen[cs]e)", ["1", "2"]),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", []),
    ("isc", "isc ", "isc licen[cs]e", []),
    ("0bsd", "bsd", "(?:0 clause|zero clause) bsd(?: licen[cs]e)?", []),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?", []),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", []),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?", []),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e", []),
    ("unlicense", "unlicense", "(?:the )?unlicense", []),
    ("cc0", "cc0", "cc0(?: universal)?", ["1 0"]),
    ("postgresql", "postgresql", "postgresql licen[cs]e", []),
    ("psf", "python", "(?:python software foundation|psf|python) licen[cs]e", ["2", "3"]),
    ("php", "php", "php licen[cs]e", ["3 0", "3 01"]),
    ("ruby", "ruby", "ruby licen[cs]e", []),
    ("openssl", "openssl", "openssl licen[cs]e", []),
    ("w3c", "w3c", "w3c software(?: notice and)? licen[cs]e", []),
    ("upl", "universal permissive", "universal permissive licen[cs]e", ["1 0"]),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[cs]e", []),
    ("x11", "x11", "x11 licen[cs]e", []),
    ("vim", "vim", "vim licen[cs]e", []),
    ("tcl", "tcl", "tcl(?: tk)? licen[cs]e", []),
    ("odbl", "open database", "open (?:data commons )?(?:open )?database licen[cs]e", ["1 0"]),
    ("odc-by", "open data commons", "open data commons attribution licen[cs]e", ["1 0"]),
    ("pddl", "public domain dedication", "public domain dedication and licen[cs]e", ["1 0"]),
    ("sspl", "server side", "server side public licen[cs]e", ["1"]),
    ("elastic", "elastic", "elastic licen[cs]e", ["1 0", "2 0"]),
    ("rpl", "reciprocal public", "reciprocal public licen[cs]e", ["1 1", "1 5"]),
    ("qpl", "q public", "q public licen[cs]e", ["1 0"]),
    ("zpl", "zope", "zope public licen[cs]e", ["1 1", "2 0", "2 1"]),
    ("apsl", "apple public", "apple public source licen[cs]e", ["1 0", "1 1", "1 2", "2 0"]),
    ("nasa", "nasa", "nasa open source agreement", ["1 3"]),
    ("ecl", "educational community", "educational community licen[cs]e", ["1 0", "2 0"]),
    ("efl", "eiffel", "eiffel forum licen[cs]e", ["1 0", "2 0"]),
    ("mulan", "mulan", "mulan permissive software licen[cs]e", ["1", "2"]),
    ("beerware", "beerware", "beerware(?: licen[cs]e)?", []),
]
# Short names as label, keyword, name (regex), versions, and whether the name alone is one.
SHORT = [
    ("agpl", "agpl", "(?:gnu )?agpl", ["1", "3"], True),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ["2", "2 1", "3"], True),
    ("gpl", "gpl", "(?:gnu )?gpl", ["1", "2", "3"], True),
    ("gfdl", "fdl", "(?:gnu fdl|(?:gnu )?gfdl)", ["1 1", "1 2", "1 3"], True),
    ("apache", "apache", "apache", ["1 0", "1 1", "2 0"], False),
    ("mpl", "mpl", "(?:mozilla )?mpl", ["1 0", "1 1", "2 0"], False),
    ("epl", "epl", "(?:eclipse )?epl", ["1 0", "2 0"], False),
    ("cddl", "cddl", "cddl", ["1 0", "1 1"], True),
    ("eupl", "eupl", "eupl", ["1 0", "1 1", "1 2"], True),
    ("sspl", "sspl", "sspl", ["1"], True),
]
GNU = ("gpl", "lgpl", "agpl", "gfdl")
# Labels whose name is also said as "MIT licensed".
LICENSED = ("mit", "apache", "bsd", "isc", "zlib", "x11", "postgresql")
# The Creative Commons variants as label, long name, short name; and their versions.
COMMONS = [
    ("cc-by", "attribution", "by"),
    ("cc-by-sa", "attribution share ?alike", "by sa"),
    ("cc-by-nd", "attribution no ?deriv(?:s|atives)", "by nd"),
    ("cc-by-nc", "attribution non ?commercial", "by nc"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike", "by nc sa"),
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(?:s|atives)", "by nc nd"),
]
COMMONS_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# Sentences of the licenses' texts as label, keyword, sentence (regex).
SENTENCES = [
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "substantial portions", "shall be included in all copies or substantial portions of the software"),
    ("isc", "any purpose", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "source and binary", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "endorse or promote", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software"),
    ("gpl", "free software", "this (?:program|library|file) is free software(?: you)? can redistribute it and or modify"),
    ("gnu", "verbatim copies", "everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document"),
    ("apache-2.0", "except in compliance", "you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "copyright licen", "perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("zlib", "plainly marked", "altered source versions must be plainly marked as such"),
    ("wtfpl", "you want to", "do what the fuck you want to"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public licen[cs]e"),
    ("public-domain", "public domain", "(?:dedicated|released|placed) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", "public domain dedication"),
    ("no-warranty", "warranty", "without warranty of any kind(?: either)? express or implied"),
    ("no-warranty", "warranty", "without any warranty without even the implied warranty"),
    ("all-rights-reserved", "rights reserved", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("commons-clause", "commons clause", "commons clause licen[cs]e condition"),
    ("copyleft", "copyleft", "copyleft(?: licen[cs]e)?"),
    ("mit", "without restriction", "to deal in the software without restriction including without limitation the rights"),
    ("mit", "merge publish", "to use copy modify merge publish distribute sublicen[cs]e and or sell copies of the software"),
    ("mit", "is furnished", "to permit persons to whom the software is furnished to do so"),
    ("mit", "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "other dealings", "out of or in connection with the software or the use or other dealings in the software"),
    ("json", "not evil", "the software shall be used for good not evil"),
    ("x11", "x consortium", "the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    ("isc", "above copyright", "for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("isc", "disclaims all", "the author disclaims all warranties with regard to this software"),
    ("isc", "performance of this", "arising out of or in connection with the use or performance of this software"),
    ("hpnd", "its documentation", "permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose"),
    ("hpnd", "publicity", "not be used in advertising or publicity pertaining to distribution of the software without specific"),
    ("hpnd", "suitability", "makes? no representations about the suitability of this software for any purpose"),
    ("bsd", "must retain", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "must reproduce", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "holders and contributors", "this software is provided by the copyright holders and contributors as is"),
    ("bsd", "regents", "this software is provided by the regents and contributors as is"),
    ("bsd", "possibility of such", "arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("bsd-3-clause", "neither the name", "neither the name of (?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse"),
    ("bsd-3-clause", "prior written", "promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "this product includes", "this product includes software developed by the university of california"),
    ("bsd-protection", "bsd protection", "bsd protection licen[cs]e"),
    ("gpl", "as published by", "gnu general public licen[cs]e as published by the free software foundation"),
    ("lgpl", "as published by", "gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation"),
    ("agpl", "as published by", "gnu affero general public licen[cs]e as published by the free software foundation"),
    ("gpl", "should have received", "you should have received a copy of the gnu general public licen[cs]e along with this"),
    ("lgpl", "should have received", "you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e"),
    ("agpl", "should have received", "you should have received a copy of the gnu affero general public licen[cs]e"),
    ("gpl", "for more details", "fitness for a particular purpose see the gnu general public licen[cs]e for more details"),
    ("lgpl", "for more details", "fitness for a particular purpose see the gnu (?:lesser|library) general public licen[cs]e for more details"),
    ("gpl", "take away your", "the licen[cs]es for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "practical works", "the licen[cs]es for most software and other practical works are designed to take away your freedom"),
    ("gpl", "franklin", "free software foundation inc 51 franklin st(?:reet)?"),
    ("gpl", "temple place", "free software foundation inc 59 temple place"),
    ("gpl", "certain conditions", "this is free software and you are welcome to redistribute it under certain conditions"),
    ("gpl", "source code as you receive", "you may copy and distribute verbatim copies of the program s source code as you receive it"),
    ("gpl-3.0", "convey verbatim", "you may convey verbatim copies of the program s source code as you receive it"),
    ("gpl-classpath-exception", "independent modules", "regardless of the licen[cs]e terms of these independent modules"),
    ("lgpl", "work in isolation", "such a work in isolation is not a derivative work of the library and therefore falls outside the scope of this licen[cs]e"),
    ("gfdl", "this document under", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("gfdl", "back cover texts", "no back cover texts a copy of the licen[cs]e is included"),
    ("apache-2.0", "asf under one", "licen[cs]ed to the apache software foundation asf under one or more contributor licen[cs]e agreements"),
    ("apache-2.0", "asf licen", "the asf licen[cs]es this file to you under the apache licen[cs]e"),
    ("apache-2.0", "applicable law", "unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis"),
    ("apache-2.0", "specific language", "see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e"),
    ("apache-2.0", "apache org", "you may obtain a copy of the licen[cs]e at https? www apache org licenses license 2 0"),
    ("apache-2.0", "patent licen", "irrevocable except as stated in this section patent licen[cs]e to make have made use offer to sell sell import"),
    ("apache-1.1", "developed by the apache", "this product includes software developed by the apache (?:software foundation|group)"),
    ("apache-1.1", "called apache", "products derived from this software may not be called apache nor may apache appear in their name"),
    ("mpl-1.1", "contents of this file", "the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("mpl-1.0", "contents of this file", "the contents of this file are subject to the mozilla public licen[cs]e version 1 0"),
    ("mpl-2.0", "secondary licen", "this source code form is incompatible with secondary licen[cs]es as defined by the mozilla public licen[cs]e"),
    ("mpl-1.1", "see the licen", "on an as is basis without warranty of any kind either express(?:ed)? or implied see the licen[cs]e"),
    ("mpl-tri-license", "alternatively", "alternatively the contents of this file may be used under the terms of either the gnu general public licen[cs]e"),
    ("npl-1.1", "contents of this file", "the contents of this file are subject to the netscape public licen[cs]e version 1 1"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
    ("epl-2.0", "secondary licen", "made available under the following secondary licen[cs]es when the conditions for such availability"),
    ("edl-1.0", "accompanies this", "eclipse distribution licen[cs]e v 1 0 which accompanies this distribution"),
    ("cpl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the common public licen[cs]e"),
    ("epl-or-cpl", "constitutes recipient", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("cddl", "contents of this file", "the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("cddl", "header notice", "when distributing covered code include this cddl header notice in each file"),
    ("cddl", "opensolaris", "you can obtain a copy of the licen[cs]e at usr src opensolaris license"),
    ("artistic-2.0", "package may be copied", "this licen[cs]e establishes the terms under which a given free software package may be copied modified distributed"),
    ("perl", "same terms as", "this is free software you can redistribute it and or modify it under the same terms as (?:the )?perl"),
    ("bsl-1.0", "person or organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e"),
    ("bsl-1.0", "accompanying file", "boost software licen[cs]e version 1 0 see accompanying file licen[cs]e 1 0 txt"),
    ("zlib", "any express or", "this software is provided as is without any express or implied warranty"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "granted to anyone", "permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("zlib", "would be appreciated", "if you use this software in a product an acknowledge?ment in the product documentation would be appreciated"),
    ("unlicense", "anyone is free", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "jurisdictions", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain"),
    ("unlicense", "relinquishment", "overt act of relinquishment in perpetuity of all present and future rights to this software"),
    ("cc0", "this deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("wtfpl", "changing it is allowed", "verbatim or modified copies of this licen[cs]e document and changing it is allowed"),
    ("postgresql", "written agreement", "for any purpose without fee and without a written agreement is hereby granted"),
    ("postgresql", "provided hereunder", "the software provided hereunder is on an as is basis"),
    ("ncsa", "deal with the software", "to deal with the software without restriction including without limitation the rights"),
    ("psf", "psf hereby", "psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e"),
    ("psf-2.0", "otherwise using python", "by copying installing or otherwise using python licensee agrees to be bound by the terms and conditions of this licen[cs]e agreement"),
    ("cnri-python", "cnri hereby", "cnri hereby grants licensee a nonexclusive royalty free world wide licen[cs]e"),
    ("php", "php software", "this product includes php software freely available from"),
    ("php-3.01", "this source file", "this source file is subject to version 3 01 of the php licen[cs]e"),
    ("php-3.0", "this source file", "this source file is subject to version 3 0 of the php licen[cs]e"),
    ("openssl", "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "called openssl", "products derived from this software may not be called openssl"),
    ("ssleay", "eric young", "this product includes (?:cryptographic )?software written by eric young"),
    ("w3c", "will comply", "the licensee agree that you have read understood and will comply with the following terms"),
    ("upl-1.0", "copyright rights", "this software associated documentation and or data collectively the software free of charge and under any and all copyright rights"),
    ("ofl-1.1", "font software", "this font software is licen[cs]ed under the sil open font licen[cs]e"),
    ("ofl-1.1", "reserved font", "no modified version of the font software may use the reserved font name s"),
    ("ofl-1.1", "sold by itself", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("cc-by", "appropriate credit", "you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made"),
    ("cc-by-sa", "build upon", "if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e as the original"),
    ("creative-commons", "as defined below", "the work as defined below is provided under the terms of this creative commons public licen[cs]e"),
    ("creative-commons", "law firm", "creative commons corporation is not a law firm and does not provide legal services"),
    ("some-rights-reserved", "some rights", "some rights reserved"),
    ("ms-pl", "accompanying software", "this licen[cs]e governs use of the accompanying software if you use the software you accept this licen[cs]e"),
    ("ms-pl", "logo or trademarks", "this licen[cs]e does not grant you rights to use any contributors name logo or trademarks"),
    ("sspl", "mongodb", "server side public licen[cs]e version 1 as published by mongodb"),
    ("elastic-2.0", "managed service", "you may not provide the software to third parties as a hosted or managed service"),
    ("elastic", "elasticsearch", "licen[cs]ed to elasticsearch (?:b v )?under one or more contributor licen[cs]e agreements"),
    ("busl-1.1", "fourth anniversary", "the fourth anniversary of the first publicly available distribution of a specific version of the licen[cs]ed work"),
    ("busl-1.1", "production use", "create derivative works redistribute and make non production use of the licen[cs]ed work"),
    ("commons-clause", "right to sell", "the licen[cs]e does not grant to you the right to sell the software"),
    ("polyform-noncommercial", "polyform", "polyform noncommercial licen[cs]e"),
    ("polyform", "polyform", "polyform (?:small business|shield|perimeter|strict|internal use) licen[cs]e"),
    ("beerware", "beer ware", "the beer ware licen[cs]e"),
    ("vim", "copies of vim", "no restrictions on distributing unmodified copies of vim except that they must include this licen[cs]e text"),
    ("ruby", "give away verbatim", "you may make and give away verbatim copies of the source form of the software without restriction"),
    ("tcl", "authors hereby", "the authors hereby grant permission to use copy modify distribute and licen[cs]e this software and its documentation for any purpose"),
    ("unicode", "data files or", "to deal in the data files or software without restriction"),
    ("eupl", "under the eupl", "licen[cs]ed under the eupl"),
    ("cecill", "french law", "this software is governed by the cecill(?: [bc])? licen[cs]e under french law"),
    ("cecill", "abiding by", "abiding by the rules of distribution of free software"),
    ("qpl", "unmodified form", "you may copy and distribute the software in unmodified form provided that the entire package"),
    ("ftl", "freetype", "portions of this software are copyright (?:[^ ]+ ){0,4}the freetype project"),
    ("ftl", "freetype", "freetype (?:project )?licen[cs]e"),
    ("ijg", "jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("info-zip", "info zip", "info zip licen[cs]e"),
    ("aal", "attribution assurance", "attribution assurance licen[cs]e"),
    ("miros", "miros", "(?:the )?miros licen[cs]e"),
    ("blueoak-1.0.0", "blue oak", "blue oak model licen[cs]e"),
    ("hippocratic", "hippocratic", "hippocratic licen[cs]e"),
    ("lal", "free art", "free art licen[cs]e"),
    ("odbl", "open database", "is made available under the open database licen[cs]e"),
    ("pddl", "is made available", "is made available under the public domain dedication and licen[cs]e"),
    ("cdla-permissive", "community data", "community data licen[cs]e agreement permissive"),
    ("cdla-sharing", "community data", "community data licen[cs]e agreement sharing"),
    ("ogl", "open government", "open government licen[cs]e"),
    ("ogl-3.0", "open government", "open government licen[cs]e v ?3 0"),
    ("openrail", "open rail", "open rail(?: m)? licen[cs]e"),
    ("openrail", "responsible ai", "responsible ai licen[cs]e"),
    ("llama", "llama", "llama (?:[0-9] ){0,2}community licen[cs]e"),
    ("us-government-rights", "computer software", "commercial computer software(?: and commercial computer software documentation)?"),
    ("proprietary", "confidential and", "this software is (?:the )?confidential and proprietary information of"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this software"),
    ("proprietary", "trade secret", "contains trade secrets? and (?:is )?proprietary"),
    ("proprietary", "may be reproduced", "no part of this software may be reproduced"),
    ("eula", "end user", "end user licen[cs]e agreement"),
    ("eula", "is subject to", "use of this software is subject to (?:the terms of )?(?:a|the) licen[cs]e agreement"),
    ("public-domain", "public domain", "this (?:software|file|work|code) is (?:in|hereby placed in(?:to)?|hereby released into) the public domain"),
    ("public-domain", "copyright protection", "not subject to copyright protection and (?:is|are) in the public domain"),
    ("dual-licensed", "dual licen", "dual licen[cs]ed under"),
    ("dual-licensed", "either licen", "under either licen[cs]e at your option"),
    ("see-license-file", "licen", "see (?:the )?licen[cs]e(?: (?:txt|md))? file"),
    ("see-license-file", "bsd style", "governed by a bsd style licen[cs]e that can be found in the licen[cs]e file"),
    ("see-license-file", "mit style", "governed by an mit style licen[cs]e that can be found in the licen[cs]e file"),
    ("see-license-file", "source tree", "licen[cs]e found in the licen[cs]e file in the root directory of this source tree"),
    ("no-warranty", "merchantability", "warranty of merchantability or fitness for a particular purpose"),
    ("no-warranty", "own risk", "use (?:of )?this software (?:is )?at your own risk"),
    ("no-warranty", "no warranty", "(?:there is|comes with|has) (?:absolutely )?no warranty"),
]
# Words of a notice before the license's name, and of a version.
NOTICE = "(?:licen[cs]ed|released|distributed|available|provided|published|covered|redistributed) (?:to you )?under (?:the )?(?:terms of (?:the )?)?"
VERSION = "(?: (?:version|v))? v?"
SHORT_VERSION = "(?: (?:licen[cs]e )?(?:version|v))? ?v?"
LATER = "(?: of the licen[cs]e)? or (?:(?:at your option )?any later version|later)"
ONLY = "(?: of the licen[cs]e)? only"
PLUS = r"\+"
# A text with none of these (letter case aside) matches no rule, and needs the regex of one of PAIRS.
GATE = ("licen cc0 copyleft wtf unencumbered domain reserved proprietary warranty beerware cecill creative bsd software "
        "plainly fuck hereby redistribution endorse agreement verbatim gpl fdl apache cddl eupl sspl").split()
PAIRS = [("cc", r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"),
         ("mpl", r"(?i)(?<![0-9a-z])mpl(?:v?[0-9]|(?![a-z]))"), ("epl", r"(?i)(?<![0-9a-z])epl(?:v?[0-9]|(?![a-z]))")]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    regex: str
    priority: int
    confidence: float


def _version(label: str, version: str) -> tuple[str, str]:
    """The label of a version, and its words (regex)."""
    words = version if " " in version else f"{version}(?: 0)?"
    return f"{label}-{version.replace(' ', '.') if ' ' in version else version + '.0'}", words


def _gnu(label: str, keyword: str, name: str, priority: int) -> list[Rule]:
    """The rules of a GNU license's version (label, name) that is the only one, or the first of several."""
    return [Rule(f"{label}-or-later", keyword, name + LATER, priority, 1.0), Rule(f"{label}-or-later", keyword, name + PLUS, priority, 1.0),
            Rule(f"{label}-only", keyword, name + ONLY, priority, 1.0)]


def _family(label: str, keyword: str, name: str, versions: list[str], version: str = VERSION, alone: bool = True) -> list[Rule]:
    out = ([Rule(label, keyword, name, 1, 0.7)] if alone else []) + [Rule(label, keyword, NOTICE + name, 2, 0.9)]
    if label in LICENSED and name.endswith(" licen[cs]e"):
        out.append(Rule(label, keyword, name + "d", 1, 0.7))
    for v in versions:
        full, words = _version(label, v)
        # the end of a short name's version is no place inside a longer number
        words += "" if version == VERSION else r"(?!\+? [0-9])"
        words += "" if label in GNU else rf"(?:{PLUS})?"
        out += [Rule(full, keyword, name + version + words, 3, 0.95),
                Rule(full, keyword, NOTICE + name + version + words, 4, 1.0)]
        if label in GNU:
            out += _gnu(full, keyword, name + version + words, 5)
    return out


def _identifiers(label: str, versions: list[str]) -> list[Rule]:
    stem = f"spdx licen[cs]e identifier {label.replace('-', ' ')}"
    out = [Rule(label, "spdx", stem, 5, 1.0)]
    for v in versions:
        full, words = _version(label, v)
        words += "" if label in GNU else rf"(?:{PLUS})?"
        out.append(Rule(full, "spdx", f"{stem} {words}", 6, 1.0))
        if label in GNU:
            out += _gnu(full, "spdx", f"{stem} {words}", 7)
    return out


def rules() -> list[Rule]:
    """All rules, those of higher priority first."""
    out = []
    for label, keyword, name, versions in FAMILIES:
        out += _family(label, keyword, name, versions) + _identifiers(label, versions)
    for label, keyword, name, versions, alone in SHORT:
        out += _family(label, keyword, name, versions, SHORT_VERSION, alone)
    for label, long, short in COMMONS:
        out += _family(label, "creative commons", f"creative commons {long}(?: international)?(?: licen[cs]e)?", COMMONS_VERSIONS)
        out += _family(label, "cc by", f"cc {short}", COMMONS_VERSIONS) + _identifiers(label, COMMONS_VERSIONS)
    out += [Rule(label, keyword, text, 4, 0.9) for label, keyword, text in SENTENCES]
    return sorted(out, key=lambda r: (-r.priority, r.label, r.regex))
