"""Whole licence texts, told apart and found without their best-known sentence."""
import random

import pytest

from airlens.llm import licenses

IDF = {w: 1.0 + len(w) / 4 for w in licenses.vocabulary()}
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
       "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
       "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
       "Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
       "notice shall be included in all copies or substantial portions of the Software.")
BSD2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD3 = BSD2 + ("\n3. Neither the name of Example Ltd nor the names of its contributors may be used to endorse or promote products "
               "derived from this software without specific prior written permission.")
UNLICENSE = ("This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, "
             "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose.")
EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"


def found(text):
    return sorted({x[0] for x in licenses.Index(IDF).scan(text)[2]})


@pytest.mark.parametrize("text,labels", [
    (MIT, ["mit"]), (BSD2, ["bsd"]), (BSD3, ["bsd", "bsd-3"]), (UNLICENSE, ["unlicense"]), (EPL, ["epl"]),
    (MIT.split("files (the", 1)[1], ["mit"]),              # without its key sentence
    (BSD2.split("met:", 1)[1], ["bsd"]), (BSD3.replace("Redistribution and use", "Use"), ["bsd", "bsd-3"]),
    ("// " + MIT.replace("\n", "\n// ").replace(", ", ",\n * "), ["mit"]), (UNLICENSE.split("\n")[1], ["unlicense"]),
    # the phrase alone, without half of its clause, is none
    ("they deal in the software without restriction here", []), ("see the eclipse public license, said he", []),
    # the words without the phrase are none
    (" ".join(sorted(MIT.split())), []), ("", []),
])
def test_whole_texts(text, labels):
    assert found(text) == labels and found("Some prose before. " + text + " And after it.") == labels


def test_lookup_equals_comparing_every_start():
    rnd, index = random.Random(4), licenses.Index(IDF)
    pool = sorted({w for _, words, _, _ in index.templates for w in words})
    for _ in range(120):
        words = []
        while len(words) < 120:
            label, template, phrase, kind = rnd.choice(index.templates)
            part = list(template)
            for _ in range(rnd.choice([0, 0, 1, 4])):
                part[rnd.randrange(len(part))] = rnd.choice(pool)
            words += part + [rnd.choice(pool) for _ in range(rnd.randint(0, 5))]
        want = set()
        for t, (label, template, phrase, kind) in enumerate(index.templates):
            for start in range(-len(template), len(words)):
                at = start + index.offset[t]
                if at < 0 or words[at:at + len(phrase)] != phrase:
                    continue
                total = sum(index.weight[t])
                share = sum(x for k, (w, x) in enumerate(zip(template, index.weight[t]))
                            if 0 <= start + k < len(words) and words[start + k] == w) / total
                if kind != "clause" or share >= licenses.CLAUSE_SHARE:
                    want.add((label, start if kind == "base" else at, 0.0 if kind == "base" else round(share, 9)))
        got = {(a, b, round(c, 9)) for a, b, c in index.scan(b" ".join(words).decode())[2]}
        assert got == want
