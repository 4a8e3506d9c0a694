import random

from tidemark.llm import licenses as X

SCANNER = X.Scanner()


def mixtures(count):
    random.seed(1)
    templates = SCANNER.auto.templates
    for _ in range(count):
        ws = []
        for _ in range(random.randint(1, 6)):
            t = random.choice(templates)
            a = random.randint(0, len(t) - 1)
            ws += t[a:random.randint(a + 1, len(t))] + random.choices(["x", "the", "license", "y"], k=random.randint(0, 2))
        yield ws


def test_base_places_equal_brute_force():
    for ws in mixtures(200):
        want = [(t, i) for i in range(len(ws)) for t in range(len(SCANNER.labels))
                if SCANNER.is_base[t] and ws[i:i + SCANNER.sizes[t]] == SCANNER.auto.templates[t]]
        assert sorted(SCANNER.matches(ws)[0]) == sorted(want)


def test_matching_statistics_equal_brute_force():
    texts = [" " + " ".join(t) + " " for t in SCANNER.auto.templates]
    for ws in mixtures(60):
        longest = []
        for e in range(1, len(ws) + 1):
            m = 0
            while m < e and any(" " + " ".join(ws[e - m - 1:e]) + " " in t for t in texts):
                m += 1
            longest.append(m)
        want = [(e, m) for e, m in enumerate(longest, 1) if m >= 3 and (e == len(ws) or longest[e] <= m)]
        found = SCANNER.matches(ws)[1]
        assert [(e, m) for e, m, _ in found] == want
        for e, m, state in found:
            places = [(t, i) for t, own in enumerate(SCANNER.auto.templates) for i in range(m, len(own) + 1)
                      if own[i - m:i] == ws[e - m:e]]
            assert sorted(SCANNER.auto.places[state]) == places


def test_pieces_equal_brute_force():
    """Every template's own maximal matches, also inside longer matches of other templates."""
    for ws in mixtures(60):
        want = set()
        for t, own in enumerate(SCANNER.auto.templates):
            for i in range(len(ws)):
                for j in range(len(own)):
                    m = 0
                    while i + m < len(ws) and j + m < len(own) and ws[i + m] == own[j + m]:
                        m += 1
                    if m >= 3 and not SCANNER.is_base[t] and not (i and j and ws[i - 1] == own[j - 1]):
                        want.add((t, i, j, m))
        found = SCANNER.matches(ws)[2]
        assert len(found) == len(set(found)) and set(found) == want


def test_complete_templates_inside_longer_matches():
    got = SCANNER.scan("This work is licensed under the GNU General Public License version 3")
    assert (got["labels"], got["score"], got["base_labels"]) == ("gpl", 1.0, "")
    assert got["spans"] == [{"label": "gpl", "start": 6, "end": 10, "share": 1.0}]
    for ws in mixtures(200):
        whole = {SCANNER.labels[t] for t, own in enumerate(SCANNER.auto.templates)
                 if any(ws[i:i + len(own)] == own for i in range(len(ws)))}
        assert whole <= set(SCANNER.scan(" ".join(ws))["labels"].split(","))
    few = X.Scanner({"long": ("one two three four five six",), "middle": ("three four five",), "short": ("two three",)}, {})
    assert few.scan("one two three four five")["labels"] == "long,middle,short"


def test_labels():
    mit = X.TEMPLATES["mit"][0]
    got = SCANNER.scan("some words " + mit.upper() + " and more, Apache License, Version 2.0")
    assert got["base_labels"] == "apache-2" and got["labels"] == "apache-2,mit" and got["n_base"] == 1 and got["score"] == 1
    ws = mit.split()
    ws[20] = "changed"                              # one changed word: two matches in one chain
    assert "mit" in SCANNER.scan(" ".join(ws))["labels"]
    assert SCANNER.scan(" ".join(ws[:len(ws) // 2]))["labels"] == ""
    got = SCANNER.scan("cc by nc, CC-BY-NC.")
    assert (got["n_base"], got["first_word"], got["last_word"], got["n_words"]) == (2, 0, 3, 6)
    assert SCANNER.scan("under the mit licenses")["n_base"] == 0


def chained(scanner, pieces):
    """Covered template spans with every earlier piece as a possible predecessor."""
    out = []
    for t in {p[0] for p in pieces}:
        own = sorted(p[1:] for p in pieces if p[0] == t)
        best = []
        for k, (at, in_t, size) in enumerate(own):
            top = (size, at)
            for j, (a, b, s) in enumerate(own[:k]):
                over = max(0, a + s - at, b + s - in_t)
                if a < at and b < in_t and over < size and max(at - a - s, in_t - b - s) <= scanner.gap:
                    top = max(top, (best[j][0] + size - over, best[j][1]), key=lambda x: x[0])
            best.append(top)
        for (n, first), (at, _, size) in zip(best, own, strict=True):
            if n >= scanner.cover * scanner.sizes[t]:
                out.append((scanner.labels[t], first, at + size, min(1.0, n / scanner.sizes[t])))
    return sorted(out)


def test_chains_equal_brute_force_where_a_phrase_repeats():
    # one match has 20 places in the template, so a piece has up to 60 earlier ones within the gap
    phrase = "you may copy it"
    template = " ".join(f"{phrase} {w}" for w in "a b c d e f g h i j k l m n o p q r s t".split())
    scanner = X.Scanner({"own": (template, "the whole of it you may copy it")}, {"under a license": "x"})
    random.seed(4)
    for _ in range(5):
        ws = template.split()
        for _ in range(random.randrange(6)):
            ws[random.randrange(len(ws))] = random.choice(["zz", "copy"])
        if random.random() < 0.5:
            ws = phrase.split() * random.randint(1, 30) + ws
        pieces = scanner.matches(ws)[2]
        assert sorted(scanner.spans(list(pieces))) == chained(scanner, pieces)
    assert scanner.scan(template)["labels"] == "own"
    for ws in mixtures(200):
        pieces = SCANNER.matches(ws)[2]
        assert sorted(SCANNER.spans(list(pieces))) == chained(SCANNER, pieces)


def test_rows(docs, odd, empty):
    for df in (docs, odd):
        got = sorted(((r.doc_id, r.n_words, r.n_base) for r in X.scan_licenses(df).collect()), key=repr)
        want = []
        for r in df.collect():
            ws = X.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
            joined = f" {' '.join(ws)} "
            want.append((r.doc_id, len(ws), sum(joined.count(f" {p} ") for p in X.BASE)))
        assert got == sorted(want, key=repr)
    assert X.scan_licenses(empty).count() == 0
