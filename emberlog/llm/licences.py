"""Licence detection by ordered signature rules.

A rule is a regular expression over the normalised words of a text, with a label, a tier and keywords. An Aho-Corasick pass over
the keywords of all rules decides which rules run on which text. Detections that overlap are resolved by priority: tiers come in
order, longer detections first within one, and a detection that lies inside one kept before it is dropped.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A-Z become a-z; digits, a-z and everything beyond ASCII stay; all else parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Phrases of the contract and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Tiers in the order of their priority, and how sure a detection of each is.
TAG, GRANT, TITLE, TEXT, LINK, NAME, HINT = range(7)
SURE = (1.0, 0.97, 0.95, 0.9, 0.85, 0.6, 0.3)

_VERB = r"(?:licen[cs]ed|released|distributed|available|published|provided|shared|offered|covered|made available|free software|used|redistributed)"
_UNDER = rf"{_VERB} (?:(?:to you|by|solely|only|freely|also|either) )*(?:under|by|through) (?:the )?(?:terms (?:and conditions )?(?:of|in) )?(?:(?:the|a|an|this|version \d+ of the) )?"
_LICENCE = r"(?: (?:public |software |open source )?licen[cs]es?(?: agreement)?)?"
_LATER = r"(?: or (?:any |at your option any )?(?:later|newer)(?: version)?| only)?"


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs over words joined by one space, only where one of ``keywords`` occurs as whole words."""

    label: str
    tier: int
    pattern: str
    keywords: tuple[str, ...]


@dataclass(frozen=True)
class Family:
    """Names of a licence, as patterns over words. ``versions`` are written with dots; the first word of each counts as its label."""

    label: str
    keywords: tuple[str, ...]
    name: str
    tags: tuple[str, ...] = ()
    versions: tuple[str, ...] = ()
    must_say_licence: bool = False


def _family(label: str, keywords: str, name: str, tags: str = "", versions: str = "", must: bool = False) -> Family:
    return Family(label, tuple(keywords.split(",")), name, tuple(t for t in tags.split(",") if t), tuple(versions.split()), must)


#: Licences: label, keywords, names, identifiers, versions, and whether the name alone means nothing.
FAMILIES = (
    _family("mit", "mit,expat", r"(?:mit|expat)(?: x11)?", "mit", must=True),
    _family("mit-0", "mit", r"mit (?:0|no attribution)", "mit 0"),
    _family("x11", "x11", r"x11", "x11", must=True),
    _family("apache", "apache,asl", r"(?:apache(?: software)?|asl)", "apache", "2.0 1.1 1.0"),
    _family("bsd-2", "bsd,freebsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", "bsd 2 clause"),
    _family("bsd-3", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", "bsd 3 clause"),
    _family("bsd-4", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", "bsd 4 clause"),
    _family("0bsd", "0bsd,bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd"),
    _family("bsd", "bsd", r"(?:berkeley )?bsd(?: style)?", "", must=True),
    _family("gpl", "gpl,gnu", r"(?:(?:gnu )?gpl|gnu general public)", "gpl", "3.0 2.0 1.0"),
    _family("lgpl", "lgpl,lesser,library", r"(?:(?:gnu )?lgpl|gnu (?:lesser|library) general public)", "lgpl", "3.0 2.1 2.0"),
    _family("agpl", "agpl,affero", r"(?:(?:gnu )?agpl|(?:gnu )?affero general public)", "agpl", "3.0 1.0"),
    _family("gfdl", "gfdl,documentation", r"(?:(?:gnu )?gfdl|gnu free documentation)", "gfdl", "1.3 1.2 1.1"),
    _family("mpl", "mpl,mozilla", r"(?:mpl|mozilla public)", "mpl", "2.0 1.1 1.0"),
    _family("epl", "epl,eclipse", r"(?:epl|eclipse public)", "epl", "2.0 1.0"),
    _family("edl", "edl,eclipse", r"(?:edl|eclipse distribution)", "edl", "1.0"),
    _family("eupl", "eupl,european", r"(?:eupl|european union public)", "eupl", "1.2 1.1 1.0"),
    _family("cddl", "cddl,distribution", r"(?:cddl|common development and distribution)", "cddl", "1.1 1.0"),
    _family("cpl", "cpl,common", r"(?:cpl|common public)", "cpl", "1.0", must=True),
    _family("cpal", "cpal,attribution", r"(?:cpal|common public attribution)", "cpal", "1.0"),
    _family("isc", "isc", r"isc", "isc", must=True),
    _family("zlib", "zlib", r"zlib(?: libpng)?", "zlib", must=True),
    _family("libpng", "libpng", r"libpng", "libpng", "2.0", must=True),
    _family("bsl", "boost", r"boost(?: software)?", "bsl", "1.0", must=True),
    _family("busl", "business,busl", r"(?:busl|business source)", "busl", "1.1"),
    _family("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense"),
    _family("wtfpl", "wtfpl", r"wtfpl", "wtfpl", "2.0"),
    _family("artistic", "artistic,perl", r"(?:perl )?artistic", "artistic", "2.0 1.0", must=True),
    _family("python", "python,psf", r"(?:psf|python(?: software foundation)?)", "python", "2.0", must=True),
    _family("php", "php", r"php", "php", "3.01 3.0", must=True),
    _family("ruby", "ruby", r"ruby", "ruby", must=True),
    _family("postgresql", "postgresql", r"postgresql", "postgresql", must=True),
    _family("openssl", "openssl", r"openssl", "openssl", must=True),
    _family("curl", "curl", r"curl", "curl", must=True),
    _family("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", "ncsa", must=True),
    _family("afl", "academic,afl", r"(?:afl|academic free)", "afl", "3.0 2.1"),
    _family("osl", "osl,open", r"(?:osl|open software)", "osl", "3.0 2.1", must=True),
    _family("ms-pl", "microsoft,ms", r"(?:ms pl|microsoft public)", "ms pl"),
    _family("ms-rl", "microsoft,ms", r"(?:ms rl|microsoft reciprocal)", "ms rl"),
    _family("ofl", "ofl,sil,font", r"(?:sil ofl|ofl|(?:sil )?open font)", "ofl", "1.1 1.0"),
    _family("odbl", "odbl,database", r"(?:odbl|open (?:data commons open )?database)", "odbl", "1.0"),
    _family("odc-by", "odc,commons", r"(?:odc by|open data commons attribution)", "odc by", "1.0"),
    _family("pddl", "pddl,dedication", r"(?:pddl|public domain dedication and)", "pddl", "1.0"),
    _family("ogl", "ogl,government", r"(?:ogl|open government)", "ogl", "3.0 2.0"),
    _family("cecill", "cecill", r"cecill", "cecill", "2.1 2.0"),
    _family("mulan", "mulan", r"mulan(?: psl| permissive software)", "mulanpsl", "2 1"),
    _family("sspl", "sspl,side", r"(?:sspl|server side public)", "sspl", "1.0"),
    _family("elastic", "elastic", r"elastic", "elastic", "2.0", must=True),
    _family("upl", "upl,permissive", r"(?:upl|universal permissive)", "upl", "1.0"),
    _family("vim", "vim", r"vim", "vim", must=True),
    _family("w3c", "w3c", r"w3c(?: software)?(?: notice and)?", "w3c", must=True),
    _family("ecl", "ecl,educational", r"(?:ecl|educational community)", "ecl", "2.0 1.0"),
    _family("openrail", "rail,openrail", r"(?:(?:bigscience |creativeml )?open ?rail(?: m)?)", "openrail"),
    _family("llama", "llama", r"llama(?: \d+)* community", "llama"),
    _family("beerware", "beerware,beer", r"beer ?ware", "beerware"),
    _family("json", "json", r"json", "json", must=True),
    _family("ijg", "jpeg,ijg", r"(?:ijg|independent jpeg group)", "ijg"),
    _family("icu", "icu,unicode", r"(?:icu|unicode)", "icu", must=True),
    _family("cc0", "cc0", r"(?:creative commons )?cc0(?: universal)?", "cc0", "1.0"),
)

#: The parts of a Creative Commons licence, in the order in which they are written.
CC = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
_CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|ativework|ative work|ativeswork)?s?(?: works)?"}
CC_VERSIONS = ("4.0", "3.0", "2.5", "2.0", "1.0")

#: Sentences that only one licence text has; label, keyword, pattern.
TEXTS = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "noninfringement", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse", r"neither the name of .{1,200}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("bsl-1", "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("gpl", "gnu", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "lesser", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "affero", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "copyleft", r"the gnu general public license is a free copyleft license"),
    ("mpl-2", "mpl", r"this source code form is subject to the terms of the mozilla public license"),
    ("apache-2", "apache", r"you may not use this file except in compliance with the license .{0,120}? apache org licenses license 2 0"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", r"do what the fuck you want to public license"),
    ("cc0", "waive", r"to the extent possible under law .{0,120}? waived? all copyright"),
    ("gfdl", "invariant", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("ofl", "font", r"this font software is licensed under the sil open font license"),
    ("beerware", "beer", r"as long as you retain this notice you can do whatever you want with this stuff"),
)

#: Places where licences are published; label, keyword, pattern.
LINKS = (
    ("mit", "opensource", r"opensource org licenses? mit"),
    ("bsd-3", "opensource", r"opensource org licenses? bsd 3 clause"),
    ("bsd-2", "opensource", r"opensource org licenses? bsd 2 clause"),
    ("isc", "opensource", r"opensource org licenses? isc"),
    ("apache-2", "apache", r"apache org licenses license 2 0"),
    ("gpl-3", "gnu", r"gnu org licenses gpl 3 0"),
    ("gpl-2", "gnu", r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("lgpl-3", "gnu", r"gnu org licenses lgpl 3 0"),
    ("agpl-3", "gnu", r"gnu org licenses agpl 3 0"),
    ("mpl-2", "mozilla", r"mozilla org (?:mpl|en us mpl) 2 0"),
    ("unlicense", "unlicense", r"unlicense org"),
    ("cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("epl-2", "eclipse", r"eclipse org legal epl 2 0"),
    ("bsl-1", "boost", r"boost org license 1 0"),
)

#: Signs that name no licence; label, keyword, pattern.
HINTS = (
    ("public-domain", "public", r"(?:in|into|to) the public domain"),
    ("all-rights-reserved", "rights", r"all rights (?:are )?reserved"),
    ("non-commercial", "commercial", r"(?:for|only for) non ?commercial (?:use|purposes?)(?: only)?"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("copyright", "copyright", r"copyright (?:c |©? ?)?(?:19|20)\d\d"),
    ("unnamed", "license", r"see (?:the )?license (?:file|txt|md)"),
)


def _spoken(version: str) -> str:
    """``2.0`` as it stands among words: with or without the last zero, with or without ``version`` before it."""
    major, *rest = version.split(".")
    tail = "".join(f" {r}" for r in rest)
    digits = f"{major}(?:{tail})?" if rest == ["0"] else f"{major}{tail}"
    if rest and rest != ["0"]:
        digits = f"(?:{digits}|{major}{''.join(rest)})"
    return rf"(?:version |v )?(?:v)?{digits}(?! \d)"


def _version_label(family: str, version: str) -> str:
    return f"{family}-{version.removesuffix('.0')}"


def _of_family(f: Family) -> Iterator[Rule]:
    says = r" (?:public |software |open source )?licen[cs]es?(?: agreement)?"
    variants = [(_version_label(f.label, v), _spoken(v)) for v in f.versions] + [(f.label, "")]
    for v in f.versions:
        if f.label in f.keywords:  # gplv3
            joined = f"{f.label}v{v.split('.')[0]}"
            rest = "".join(rf" {r}" for r in v.split(".")[1:])
            yield Rule(_version_label(f.label, v), TITLE, rf"{joined}(?:{rest})?(?! \d){_LATER}" if v.endswith(".0") else rf"{joined}{rest}{_LATER}", (joined,))
    for label, version in variants:
        named = rf"{f.name}{_LICENCE} {version}{_LATER}" if version else rf"{f.name}{_LICENCE}"
        for tag in f.tags:
            yield Rule(label, TAG, rf"spdx license identifier {tag}{' ' + version if version else '(?! \\d)'}{_LATER}", ("spdx",))
        yield Rule(label, GRANT, rf"{_UNDER}{named}", f.keywords)
        if version:
            yield Rule(label, TITLE, named if f.must_say_licence is False else rf"{f.name}{says} {version}{_LATER}", f.keywords)
            yield Rule(label, NAME, rf"(?:licen[cs]e|licensing) {f.name} {version}", f.keywords)
        else:
            yield Rule(label, NAME, rf"{f.name}{says}", f.keywords)
            yield Rule(label, NAME, rf"licen[cs]e {f.name}(?! \d)", f.keywords)


def _of_creative_commons() -> Iterator[Rule]:
    for parts in CC:
        short = parts.replace("-", " ")
        long = " ".join(_CC_WORDS[p] for p in parts.split("-"))
        for version in (*CC_VERSIONS, ""):
            spoken = rf" {_spoken(version)}" if version else r"(?! \d)"
            tail = rf"{spoken}(?! (?:nc|sa|nd))" if version else r"(?! (?:nc|sa|nd|\d))"
            label = f"cc-{parts}-{version.removesuffix('.0')}" if version else f"cc-{parts}"
            names = rf"(?:cc {short}|creative commons (?:licen[cs]e )?(?:{short}|{long})(?: (?:international|unported|generic|public))*(?: licen[cs]e)?)"
            yield Rule(label, TAG, rf"spdx license identifier cc {short}{tail}", ("spdx",))
            yield Rule(label, GRANT, rf"{_UNDER}{names}{tail}", ("cc", "creative"))
            yield Rule(label, TITLE, rf"{names}{tail}", ("cc", "creative"))
            if version:
                slug = " ".join(version.split("."))
                yield Rule(label, LINK, rf"creativecommons org licenses {short} {slug}(?! \d)", ("creativecommons",))
    yield Rule("cc", NAME, r"creative commons", ("creative",))


def rules() -> list[Rule]:
    """All rules, strongest tier first; within a tier in the order of the tables above."""
    found = [r for f in FAMILIES for r in _of_family(f)] + list(_of_creative_commons())
    for tier, table in ((TEXT, TEXTS), (LINK, LINKS), (HINT, HINTS)):
        found += [Rule(label, tier, pattern, (keyword,)) for label, keyword, pattern in table]
    return sorted(found, key=lambda r: r.tier)


@dataclass(frozen=True)
class Found:
    """Words ``start`` to ``stop`` of a text carry rule ``rule``."""

    start: int
    stop: int
    rule: int


class Scanner:
    """Compiled rules; ``base`` phrases are detected apart, as plain word sequences."""

    def __init__(self, ordered: Sequence[Rule], base: Sequence[tuple[str, str]] = BASE) -> None:
        self.rules, self.base = list(ordered), list(base)
        self.patterns = [re.compile(rf"(?<= ){r.pattern}(?= )") for r in self.rules]
        self.tiers = np.array([r.tier for r in self.rules])
        gates: dict[str, list[int]] = defaultdict(list)
        for i, r in enumerate(self.rules):
            for k in r.keywords:
                gates[k].append(i)
        for i, (phrase, _) in enumerate(self.base):
            gates[phrase.split()[0]].append(~i)
        self.gates = {k: tuple(v) for k, v in gates.items()}
        self.keywords = ahocorasick.Automaton()
        for k in self.gates:
            self.keywords.add_word(f" {k} ", k)
        self.keywords.make_automaton()

    def prefilter(self, folded: str) -> set[str]:
        """Keywords that occur in folded text as whole words."""
        return {k for _, k in self.keywords.iter(folded)}

    def detect(self, words: str, keywords: set[str]) -> tuple[list[int], set[str], list[Found]]:
        """Base places (start words), base labels and all detections in ``words``: words joined and surrounded by spaces."""
        gates = {i for k in keywords for i in self.gates[k]}
        spaces = np.flatnonzero(np.frombuffer(words.encode("latin-1"), np.uint8) == 32)
        places, labels, found = [], set(), []
        for i in sorted(gates):
            if i < 0:
                phrase, label = self.base[~i]
                at = words.find(f" {phrase} ")
                while at >= 0:
                    places.append(int(np.searchsorted(spaces, at)))
                    labels.add(label)
                    at = words.find(f" {phrase} ", at + 1)
                continue
            for m in self.patterns[i].finditer(words):
                start, stop = np.searchsorted(spaces, (m.start(), m.end()))
                found.append(Found(int(start) - 1, int(stop), i))
        return sorted(places), labels, found

    def resolve(self, found: list[Found]) -> list[Found]:
        """Detections that stay: tier by tier, longer first, dropping what lies inside a kept one of its own or an earlier tier.

        Of equal spans in one tier the earlier rule stays. One sorted sweep per tier, so many detections cost no more than sorting.
        """
        kept: list[Found] = []
        for tier in sorted({int(self.tiers[f.rule]) for f in found}):
            here = sorted((f for f in found if self.tiers[f.rule] == tier), key=lambda f: (f.start, -f.stop, f.rule))
            before = sorted((f.start, f.stop) for f in kept)
            at, reach = 0, -1
            for f in here:
                while at < len(before) and before[at][0] <= f.start:
                    reach = max(reach, before[at][1])
                    at += 1
                if f.stop > reach:
                    kept.append(f)
                    reach = f.stop
        return sorted(kept, key=lambda f: (f.start, f.stop, f.rule))


@lru_cache(maxsize=1)
def _own_rules() -> Scanner:
    return Scanner(rules())


_RESULT = pa.schema([
    ("n_words", pa.int64()), ("base_starts", pa.list_(pa.int64())), ("base_labels", pa.list_(pa.string())), ("score", pa.float64()),
    ("found", pa.list_(pa.struct([("label", pa.string()), ("tier", pa.int32()), ("start", pa.int64()), ("n", pa.int64())]))),
])
_RESULT_DDL = "n_words long, base_starts array<long>, base_labels array<string>, score double, found array<struct<label: string, tier: int, start: long, n: long>>"


def _scan_texts(scanner: Scanner, texts: list[str | None]) -> pa.RecordBatch:
    n_words, starts, labels, scores, found = [], [], [], [], []
    folded = [(t or "").encode("utf-8", "replace").translate(_FOLD) for t in texts]
    for raw in folded:
        data = np.frombuffer(raw, np.uint8) != 32
        n_words.append(int(np.count_nonzero(data[1:] & ~data[:-1])) + (int(data[0]) if len(data) else 0))
        keywords = scanner.prefilter(f" {raw.decode('latin-1')} ")
        if not keywords:
            starts.append([]), labels.append([]), scores.append(0.0), found.append([])
            continue
        words = f" {' '.join(raw.decode('latin-1').split(' '))} "
        words = re.sub(" +", " ", words)
        places, base, all_found = scanner.detect(words, keywords)
        kept = scanner.resolve(all_found)
        starts.append(places)
        labels.append(sorted(base))
        scores.append(max([SURE[scanner.rules[f.rule].tier] for f in kept] + [1.0] * bool(places), default=0.0))
        found.append([{"label": scanner.rules[f.rule].label, "tier": scanner.rules[f.rule].tier, "start": f.start, "n": f.stop - f.start} for f in kept])
    arrays = [pa.array(c, t) for c, t in zip((n_words, starts, labels, scores, found), _RESULT.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_RESULT)


def _pieces(texts: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    a = 0
    while a < len(ends):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield a, b
        a = b


def scan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``row`` (the columns ``keep``, whatever their names), ``n_words, base_starts, base_labels, score, found`` for every row of ``docs``.

    ``found`` holds the detections that stay (label, tier, first word, number of words) in text order, ``base_starts`` the first words of
    the base phrases, which no other detection suppresses. ``score`` is the certainty of the strongest detection, 0 without one.
    A null text counts as empty: no words, no detections, score 0. Texts are scanned whole, about a million characters of a batch at a
    time and a longer text alone. Repeated rows are scanned each; an empty table gives no rows; other columns are not read.
    """
    kept = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _own_rules()
        for batch in batches:
            for a, b in _pieces(batch.column(1)):
                done = _scan_texts(scanner, batch.column(1).slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *done.columns], names=["row", *_RESULT.names])

    row = kept.schema["row"].dataType.simpleString()
    return kept.mapInArrow(run, f"row {row}, {_RESULT_DDL}")


def labelled(scanned: DataFrame) -> DataFrame:
    """The scan as flat columns: labels distinct, sorted and joined by commas; those of the base phrases always stay."""
    every = F.array_union("base_labels", F.transform("found", lambda f: f["label"]))
    return scanned.select(
        "row.*", "n_words", F.size("base_starts").cast("long").alias("n_base"), F.array_min("base_starts").alias("first_word"),
        F.array_max("base_starts").alias("last_word"), F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"), "score",
    )
