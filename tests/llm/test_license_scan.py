import re

from tessera.llm import license_scan as L

from .cases import AWKWARD, docs_frame

TEXTS = ["Released under the MIT License.", "under the mit license under THE-mit_license; cc by-nc 4.0 x", "Licensed under the Apache License, Version 2.0.",
         "Lincensed undr the Apache Licence, Version 2.0", "munder the mit license", "under the mit licenses é", "All rights reserved", "all right reserved!", "nothing here",
         "ünder the mit license", "Redistribution and use in source and binary form", "words " * 3000 + "Licensed under CC BY-NC 4.0." + " tail" * 3000,
         "apache license version 2 " * 500]


def base(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split(" ")
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), len(found), min(found, default=(None,))[0], max(found, default=(None,))[0], ",".join(sorted({x for _, x in found}))


def test_base_columns_against_brute_force(spark):
    texts = AWKWARD + TEXTS
    rows = L.scan_licenses(docs_frame(spark, texts)).collect()
    got = sorted(((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    assert got == sorted((base((t[1] if isinstance(t, tuple) else t) or "") for t in texts), key=str)
    assert L.scan_licenses(docs_frame(spark, TEXTS).limit(0)).collect() == []


def test_fuzzy_notices(spark):
    got = {r.doc_id: r for r in L.scan_licenses(docs_frame(spark, TEXTS)).collect()}
    assert [got[i].labels for i in range(len(TEXTS))] == [
        "mit", "cc-by-nc,mit", "apache-2", "apache-2", "mit", "mit", "all-rights-reserved", "all-rights-reserved", "", "mit", "bsd", "cc-by-nc", "apache-2"]
    assert got[3].n_base == 0 and 0.8 < got[3].score < 1 and got[8].score == 0 and got[0].score == 1
    s = got[10].spans[0]
    assert TEXTS[10][s["from"]:s["to"]] == TEXTS[10] and s.errors == 1
    s = got[11].spans[0]
    assert TEXTS[11][s["from"]:s["to"]] == "Licensed under CC BY-NC 4.0"


def kept(text):
    return [w for w in text.split() if w in L.NAMING or w.isdigit()]


def test_pigeonhole_loses_nothing():
    """Every text within the error bound of a notice is found: all single edits of a notice that leave the words that name
    the license; an edit of those gives no label of that license."""
    scanner = L.Scanner({}, L.NOTICES)
    for wording, label in L.NOTICES.items():
        for i in range(1, len(wording)):
            for edited in (wording[:i] + wording[i + 1:], wording[:i] + "z" + wording[i:], wording[:i] + "z" + wording[i + 1:]):
                found = {s.label for s in scanner.fuzzy(f" aa {edited} bb ")}
                same = kept(edited) == kept(wording) or (kept(edited) + ["0"] == kept(wording))
                assert (label in found) == same, (wording, edited)


def test_names_are_not_edited_away():
    scanner = L.Scanner(L.PHRASES, L.NOTICES)
    labels = lambda text: L.scan_text(scanner, text)[5]
    assert labels("Licensed under CC BY-SA 4.0") == "cc-by-sa"
    assert labels("Licensed under CC BY-ND 4.0") == "cc-by-nd"
    assert labels("Licensed under CC BY 4.0") == "cc-by"
    assert labels("licensed under the GNU General Public License version 2") == "gpl-2"
    assert labels("licensed under the GNU General Public License version 3") == "gpl-3"
    assert labels("licensed under the GNU General Public License version 1") == ""
    assert labels("Mozilla Public License Version 1.1") == "mpl-1-1" and labels("Mozila Public License, Version 2.0") == "mpl-2"
    assert labels("Licensed under the Apache License, Version 1.1") == "apache-1-1"
    assert labels("under the MPL license") == "" and labels("under the mti license") == ""
    assert labels("Mozilla Public License Version 2") == "mpl-2" and labels("Mozilla Public License Version 2.5") == ""
    assert labels("licensed under the gnu lesser general public license version 2.1") == "lgpl"


def plain_spans(text, notices, rate):
    """Labels by a search of every place: least edits of a notice against any run of whole words, by dynamic programming."""
    line = f" {' '.join(L.WORDS.findall(L.lowered(text)))} "
    out = set()
    for wording, label in L.variants(notices).items():
        most = max(1, int(len(wording) * rate))
        cuts = [i for i, c in enumerate(line) if c == " "]
        for a in cuts[:-1]:
            row = list(range(len(wording) + 1))
            for at in range(a + 1, min(len(line), a + 2 + len(wording) + most)):
                if line[at] == " " and row[-1] <= most and at > a + 1:
                    behind = line[at + 1:].split(" ", 1)[0]
                    if L.Scanner.named(wording, line[a + 1:at], behind):
                        out.add(label)
                new = [row[0] + 1]
                for j, c in enumerate(wording):
                    new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (line[at] != c)))
                row = new
    return out


def test_labels_equal_a_search_of_every_place():
    import random
    rng = random.Random(8)
    notices = {k: L.NOTICES[k] for k in ("under the mit license", "licensed under cc by sa 4 0", "mozilla public license version 2 0", "all rights reserved")}
    scanner = L.Scanner({}, notices, 0.12)
    for _ in range(150):
        own = list(rng.choice(list(notices)))
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(own))
            own[i:i + rng.randrange(2)] = rng.choice(["", "x", "e"])
        text = f"some words {''.join(own)} and more"
        assert {s.label for s in scanner.fuzzy(f" {' '.join(L.WORDS.findall(text))} ")} == plain_spans(text, notices, 0.12), text
