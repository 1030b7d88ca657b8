import re

import regex

from concord.llm import licenses, registry


def bigrams(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    return set(zip(words, words[1:]))


def templates():
    def shared(p):
        return sum(any(p in t.split("\n\n") for t in texts) for texts in licenses.TEMPLATES.values()) > 1

    for name, texts in licenses.TEMPLATES.items():
        parts = dict.fromkeys(p for t in texts for p in [t, *t.split("\n\n")] if p == t or not shared(p))
        for i, p in enumerate(parts):
            yield f"{name}#{i}", name, bigrams(p)


def brute(pairs, least=0.8):
    """Every line, paragraph and whole text against every template."""
    known, best = list(templates()), {}
    for d, text in pairs:
        text = text or ""
        for unit in {*text.split("\n"), *re.split(r"\n\s*\n", text), text}:
            own = bigrams(unit)
            for template, name, wanted in known if own else ():
                dice = round(2 * len(own & wanted) / (len(own) + len(wanted)), 6)
                if dice >= least:
                    best[d, name] = min(best.get((d, name), (0, "")), (-dice, template))
    return {k: (t, -s) for k, (s, t) in best.items()}


def result(found):
    return {(r.doc_id, r.license): (r.template, r.dice) for r in found.collect()}


def test_query_equals_brute_force(spark):
    pairs = [tuple(r) for r in registry.documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect()]
    wanted = brute(pairs)
    assert result(registry.op7_license_scan(spark, "/root/testdata/sf0.001")) == wanted
    assert wanted


def test_texts_of_templates(make_docs, edge_pairs):
    whole = [t for texts in licenses.TEMPLATES.values() for t in texts]
    pairs = [(100 + i, f"before\n{t}\nafter") for i, t in enumerate(whole)] + [(200 + i, t.upper().replace(" ", "  ")) for i, t in enumerate(whole)] + edge_pairs
    got = result(licenses.scan(make_docs(pairs, clash=True)))
    assert got == brute(pairs)
    assert {name for _, name in got} == set(licenses.TEMPLATES)


def test_blanks_and_repeats_hide_nothing(make_docs):
    mit, zlib = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Zlib"][0]
    gap = " " * 9_000
    pairs = [
        (1, f"This project is licensed\n{gap}under the terms\n\n{gap}of the MIT license."),
        (2, "\n\n".join(zlib.replace("\n\n", "\n").split(" ")) + "\n" * 10_000),
        (3, "\n".join([mit[3].replace("\n\n", "\n\n \n")] * 200)),
        (4, "word " * 30_000 + mit[2]),
        (5, "MIT"),
        (6, "a b"),
    ]
    got = result(licenses.scan(make_docs(pairs)))
    assert got == brute(pairs)
    assert {(1, "MIT"), (2, "Zlib"), (3, "MIT")} <= set(got)


def test_empty_table(make_docs):
    assert licenses.scan(make_docs([])).collect() == []
