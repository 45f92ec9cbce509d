"""Licence recognition from known sentences and their order, in built-in functions only.

A text is cut into sentences, each is normalised (ASCII letters and digits in lower case,
single spaces) and mapped to the identifiers of the known licence sentences that it says.
The identifiers of a text, in order, with ``-`` for any other sentence, are then matched
against ordered licence rules; a rule's sentences may have ``GAP`` other ones in between.

``SENTENCES``, ``BREAK`` and ``TELLING`` belong to the registered SQL, which says the same
of texts whose statements are whole lines in the wording of ``SENTENCES``. The operator
itself reads ``SAYINGS`` (any subject and tail, and the usual wordings of each licence) in
sentences that may run over several lines.
"""

from pyspark.sql import functions as F

GAP = 2

#: Identifier and pattern of a normalised sentence. Every pattern holds one
#: of the words in ``TELLING``.
SENTENCES = {
    "apache2": r"licensed under (the )?apache licen[cs]e,? version 2 0( the license)?",
    "apache2comply": r"you may not use this file except in compliance with the license",
    "apache2copy": r"you may obtain a copy of the license at.*",
    "warranty_asis": r"unless required by applicable law or agreed to in writing software distributed"
                     r" under the license is distributed on an as is basis.*",
    "mit": r"(released|licensed|distributed) under the (terms of the )?mit licen[cs]e",
    "mitgrant": r"permission is hereby granted free of charge to any person obtaining a copy of this"
                r" software and associated documentation files.*",
    "mitnotice": r"the above copyright notice and this permission notice shall be included in all copies"
                 r" or substantial portions of the software",
    "mitwarranty": r"the software is provided as is without warranty of any kind.*",
    "bsdgrant": r"redistribution and use in source and binary forms with or without modification are"
                r" permitted provided that the following conditions are met.*",
    "bsdsource": r"(\d )?redistributions of source code must retain the above copyright notice.*",
    "bsdbinary": r"(\d )?redistributions in binary form must reproduce the above copyright notice.*",
    "bsdendorse": r"(\d )?neither the name of .* may be used to endorse or promote products derived from"
                  r" this software without specific prior written permission",
    "bsdwarranty": r"this software is provided by .* as is and any express or implied warranties.*",
    "bsd": r"(released|licensed|distributed) under the (\d clause )?bsd licen[cs]e",
    "gpl3": r"this work is licensed under the gnu general public license version 3",
    "gpl2": r"this work is licensed under the gnu general public license version 2",
    "gplfree": r".*is free software you can redistribute it and or modify it under the terms of the gnu"
               r" general public license as published by the free software foundation.*",
    "gplhope": r".*is distributed in the hope that it will be useful but without any warranty.*",
    "lgpl": r".*licensed under the gnu lesser general public license( version \d( \d)?)?",
    "agpl": r".*licensed under the gnu affero general public license( version \d( \d)?)?",
    "mpl2": r".*subject to the terms of the mozilla public license v(ersion)? ?2 0",
    "ccbync4": r".*licensed under (a )?(cc by nc|creative commons attribution noncommercial) 4 0.*",
    "ccbysa4": r".*licensed under (a )?(cc by sa|creative commons attribution sharealike) 4 0.*",
    "ccby4": r".*licensed under (a )?(cc by|creative commons attribution) 4 0.*",
    "cc0": r".*(dedicated to the public domain|cc0 1 0 universal).*licen[cs]e.*",
    "reserved": r"(copyright .*)?all rights reserved( no permission.*)?",
    "spdxapache2": r"spdx license identifier apache 2 0",
    "spdxmit": r"spdx license identifier mit",
    "spdxgpl3": r"spdx license identifier gpl 3 0.*",
    "spdxgpl2": r"spdx license identifier gpl 2 0.*",
}

#: "is licensed to you under the terms of the", also "under either Apache 2.0 or the"; not
#: "is not licensed under".
STATED = (r"(?<!\b(?:not|never|longer|nor|not be|never be|formerly|previously) )"
          r"(?:licen[cs]ed|released|distributed?|available|provided|published|offered|covered"
          r"|redistributed?|modify|copy|use) (?:(?:it|them|this \w+) )?(?:and or modify (?:it )?)?(?:to you )?"
          r"(?:only )?(?:under|by|subject to|according to|in accordance with) "
          r"(?:(?:\w+ ){0,12}(?:or|and|either|both) )?(?:(?:a|an|the|either|of|both) )*"
          r"(?:(?:terms|conditions)(?: and (?:terms|conditions))? of )?(?:(?:a|an|the|either|of|both) )*")
#: "version 2", "v2 0", "2 0" and no other version.
_NUMBER = r"(?:(?:version|ver|v) ?)?{}(?: 0)?(?! \d\b)\b"
_GPL = r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: gnu gpl| gpl)?"
_LESSER = r"(?:gnu )?(?:(?:lesser|library) (?:general )?public licen[cs]e|lgpl ?v?\d?)\b"
_AFFERO = r"(?:gnu )?(?:affero (?:general )?public licen[cs]e|agpl ?v?\d?)\b"
_OF = r"(?:version|v) \d(?: \d)?(?: or later| only| or any later version)? of (?:the )?"
_CC = r"(?:cc|creative commons) "
_BY = r"(?:by|attribution)"


def _gpl(number):
    numbered = _NUMBER.format(number)
    return (rf"{STATED}(?:{_GPL} ?(?:licen[cs]e )?{numbered}"
            rf"|(?:version|v) ?{number}(?: 0)?(?: or later| only| or any later version)? of (?:the )?{_GPL}\b)")


#: Identifier and pattern, sought anywhere in a normalised sentence, so that
#: subject and tail are free. A sentence may say several.
SAYINGS = {
    "apache2": rf"{STATED}(?:apache|asl)(?: software)?(?: foundation)?(?: (?:public )?licen[cs]e)? ?"
               rf"{_NUMBER.format(2)}|{STATED}(?:version|v) ?2(?: 0)? of (?:the )?apache licen[cs]e\b",
    "apache2comply": r"\byou may not use (?:this|these|the) \w+ except in compliance with the licen[cs]e\b",
    "apache2copy": r"\byou may obtain a copy of the licen[cs]e at\b",
    "warranty_asis": r"\bunless required by applicable law or agreed to in writing (?:this )?software distributed"
                     r" under the licen[cs]e is distributed on an as is basis\b",
    "mit": rf"{STATED}(?:mit|expat)(?: x11| expat| open source)?(?: licen[cs]es?\b| or | and |$)",
    "mitgrant": r"\bpermission is hereby granted free of charge to any person obtaining a copy of this"
                r" software and associated documentation files\b",
    "mitnotice": r"\bthe above copyright notice and this permission notice (?:including the next paragraph )?"
                 r"shall be included in all copies or substantial portions of the software\b",
    "mitwarranty": r"\bthe software is provided as is without warranty of any kind\b",
    "bsdgrant": r"\bredistribution and use in source and binary forms with or without modification are"
                r" permitted provided that the following conditions are met\b",
    "bsdsource": r"\bredistributions of source code must retain the above copyright notice\b",
    "bsdbinary": r"\bredistributions in binary form must reproduce the above copyright notice\b",
    "bsdendorse": r"\b(?:neither )?the names? of .* may (?:not )?be used to endorse or promote products derived"
                  r" from this software without specific prior written permission\b",
    "bsdwarranty": r"\bthis software is provided by .* as is and any express or implied warranties\b",
    "bsd": rf"{STATED}(?:(?:new|modified|revised|simplified|original|\d clause) )*bsd(?: \d clause)?"
           r"(?: licen[cs]es?\b| or | and |$)",
    "gpl3": _gpl(3),
    "gpl2": _gpl(2),
    "gplfree": r"\bis free software you can redistribute it and or modify it under the terms of"
               rf" (?:version \d of )?the gnu general public licen[cs]e\b"
               rf"|{STATED}{_GPL}(?! ?(?:licen[cs]e )?(?:(?:version|ver|v) ?)?\d)\b",
    "gplhope": r"\bis distributed in the hope that it will be useful but without any warranty\b",
    "lgpl": rf"{STATED}(?:{_OF})?{_LESSER}",
    "agpl": rf"{STATED}(?:{_OF})?{_AFFERO}",
    "mpl2": rf"(?:{STATED}|\bsubject to the terms of (?:the )?)(?:mozilla public licen[cs]e(?: mpl)?|mpl) ?"
            rf"{_NUMBER.format(2)}",
    "ccbync4": rf"{STATED}{_CC}{_BY} (?:nc|non ?commercial) 4 0\b",
    "ccbysa4": rf"{STATED}{_CC}{_BY} (?:sa|share ?alike) 4 0\b",
    "ccby4": rf"{STATED}{_CC}{_BY} 4 0\b",
    "cc0": rf"\b(?:dedicated to the public domain|cc0 1 0 universal)\b.*licen[cs]e|{STATED}(?:creative commons )?cc0\b",
    "reserved": r"\ball rights reserved\b",
    "spdxapache2": r"\bspdx license identifier (?:\S+ ){0,8}?apache 2 0\b",
    "spdxmit": r"\bspdx license identifier (?:\S+ (?:or|and) |[a-z0-9 ]{1,40} (?:or|and) )?mit\b",
    "spdxgpl3": r"\bspdx license identifier (?:[a-z0-9 ]{1,40} (?:or|and) )?gpl 3 0\b",
    "spdxgpl2": r"\bspdx license identifier (?:[a-z0-9 ]{1,40} (?:or|and) )?gpl 2 0\b",
}

#: Licence and the sentences that say it, in order; longer rules come first.
RULES = [
    ("MIT", ["mitgrant", "mitnotice", "mitwarranty"]),
    ("BSD-3-Clause", ["bsdgrant", "bsdsource", "bsdbinary", "bsdendorse", "bsdwarranty"]),
    ("BSD-2-Clause", ["bsdgrant", "bsdsource", "bsdbinary", "bsdwarranty"]),
    ("Apache-2.0", ["apache2", "apache2comply", "apache2copy", "warranty_asis"]),
    ("Apache-2.0", ["apache2", "apache2comply"]),
    ("GPL", ["gplfree", "gplhope"]),
    ("Apache-2.0", ["apache2"]), ("Apache-2.0", ["spdxapache2"]),
    ("MIT", ["mit"]), ("MIT", ["spdxmit"]), ("BSD", ["bsd"]),
    ("GPL-3.0", ["gpl3"]), ("GPL-3.0", ["spdxgpl3"]),
    ("GPL-2.0", ["gpl2"]), ("GPL-2.0", ["spdxgpl2"]), ("GPL", ["gplfree"]),
    ("LGPL", ["lgpl"]), ("AGPL", ["agpl"]), ("MPL-2.0", ["mpl2"]),
    ("CC-BY-NC-4.0", ["ccbync4"]), ("CC-BY-SA-4.0", ["ccbysa4"]), ("CC-BY-4.0", ["ccby4"]),
    ("CC0-1.0", ["cc0"]), ("All-Rights-Reserved", ["reserved"]),
]

#: A text without any of these says none of the sentences.
TELLING = r"(?i)licen[cs]e|permission|warrant|redistribut|all rights reserved"
BREAK = r"[.!?;]+\s+|[\r\n]+"
#: What stands before the text of a line in comments and quotes.
LEADER = r"(?m)^[ \t]*(?:(?:[*#/%;>|]+|--+|<!--+|dnl|REM)(?=\s|$))?[ \t]*"
#: Ends of sentences and paragraphs, and list bullets; other line breaks are blanks. No end is
#: the mark of "v. 2.0".
PARTING = (r"(?<!\b[vV])[.!?;]+\s+|(?:\r\n|\r(?!\n)|\n)[ \t]*[\r\n]\s*"
           r"|(?:\r\n|[\r\n])(?=(?:[-\u2022]|\(?\d{1,2}[.)]|\(?[a-z]\))[ \t])")
#: ``TELLING`` for sayings, over blanks of any kind and the short names.
SPEAKING = (r"(?i)licen[cs]e|permission|warrant|redistribut|all[^A-Za-z0-9]+rights[^A-Za-z0-9]+reserved"
            r"|\b(?:a|l)?gpl|under\W+(?:the\W+)?mit\b|\bbsd\b|\bapache\b|\bmpl\b|\bcc0|\bcc[^A-Za-z0-9]+by\b"
            r"|creative[^A-Za-z0-9]+commons|public[^A-Za-z0-9]+domain")


def sequence_pattern(ids):
    """A rule as a pattern over ``" id id - id "``: the ids in order, gaps between."""
    gap = f"(?: -){{0,{GAP}}}"
    return " " + f"{gap} ".join(ids) + r"\b"


def said(sentence):
    """The identifiers of all that a normalised sentence says, ``-`` for nothing, as a column."""
    found = F.concat_ws(" ", *[
        F.when(sentence.rlike(pattern), F.lit(name)) for name, pattern in SAYINGS.items()])
    return F.when(found == "", "-").otherwise(found)


def normalised(sentence):
    """ASCII letters and digits in lower case, with one space between."""
    words = F.regexp_replace(sentence, "[^A-Za-z0-9]+", " ")
    return F.lower(F.btrim(words))


def sentence_ids(text):
    """The identifiers of a text's sentences, in order, as ``" id id - id"``.

    Sentences run over line breaks and through comment leaders.
    """
    sentences = F.filter(F.transform(
        F.split(F.regexp_replace(text, LEADER, ""), PARTING), normalised), lambda s: s != "")
    ids = F.transform(sentences, lambda s: F.when(s.rlike(SPEAKING), said(s)).otherwise("-"))
    return F.when(text.rlike(SPEAKING), F.concat(F.lit(" "), F.array_join(ids, " "))).otherwise("")


def licences(docs):
    """``doc_id``, the licences that its text states (distinct, in order, comma-joined), how
    many statements matched, and how many known sentences belong to none of them.

    Null and empty texts, and texts without known sentences, state none: an empty text and
    zeros. Repeated rows give repeated rows, extra columns are ignored, and an empty table
    gives no rows. Where rules overlap, the one listed first takes the sentences. Wrapped
    and commented notices are read like those in one line.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", sentence_ids(text).alias("ids"))
    matched = F.col("ids")
    for name, ids in RULES:
        matched = F.regexp_replace(matched, sequence_pattern(ids), f" <{name}>")
    rows = rows.select("doc_id", F.when(F.col("ids").rlike("[a-z]"), matched).otherwise("").alias("m"))
    stated = F.regexp_extract_all("m", F.lit("<([^>]+)>"), 1)
    rest = F.regexp_extract_all("m", F.lit(" ([a-z][a-z0-9_]*)"), 1)
    return rows.select(
        "doc_id", F.array_join(F.array_distinct(stated), ",").alias("licences"),
        F.size(stated).cast("long").alias("n_statements"),
        F.size(rest).cast("long").alias("n_other_sentences"))


def licences_sql():
    """The same in SQL over ``documents``."""
    case = " ".join(
        f"when regexp_full_match(s, '{p}') then '{n}'" for n, p in SENTENCES.items())
    matched = "ids"
    for name, ids in RULES:
        pattern = sequence_pattern(ids)
        matched = f"regexp_replace({matched}, '{pattern}', ' <{name}>', 'g')"
    return f"""
    with sentences as (
        select doc_id, coalesce(text, '') as text, list_filter(list_transform(
            regexp_split_to_array(coalesce(text, ''), '{BREAK}'),
            lambda x: lower(trim(regexp_replace(x, '[^A-Za-z0-9]+', ' ', 'g')))),
            lambda x: x <> '') as sentences
        from documents),
    coded as (
        select doc_id, case when regexp_matches(text, '{TELLING}') then ' ' || array_to_string(
            list_transform(sentences, lambda s: case when not regexp_matches(s, '{TELLING}') then '-'
                {case} else '-' end), ' ') else '' end as ids
        from sentences),
    matched as (
        select doc_id, case when regexp_matches(ids, '[a-z]') then {matched} else '' end as m
        from coded),
    found as (
        select doc_id, regexp_extract_all(m, '<([^>]+)>', 1) as stated,
            len(regexp_extract_all(m, ' ([a-z][a-z0-9_]*)', 1)) as n_other_sentences
        from matched)
    select doc_id, array_to_string(list_transform(list_filter(
            list_zip(stated, range(1, len(stated) + 1)),
            lambda x: list_position(stated, x[1]) = x[2]), lambda x: x[1]), ',') as licences,
        len(stated)::bigint as n_statements, n_other_sentences::bigint as n_other_sentences
    from found
    """
