"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size=5):
    words = WORD.findall(fold(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(rows, percent=85):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in rows}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    shared = defaultdict(int)
    for ids in by_shingle.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                shared[a, b] += 1
    links = [p for p, n in shared.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    found = components(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def entities(text):
    """{kind: [(start, end)]} of the base kinds."""
    text = text or ""
    only = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(only(m)) <= 19 and luhn(only(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(only(m)) <= 15],
    }


def identifiers(texts, kinds=("email", "ip", "card", "phone"), least_rounds=3, support=8, confident=0.6):
    """{position of a text: [(start, end)]} of identifiers found by the bootstrap, with plain dictionaries."""
    slots = []
    for nth, text in enumerate(texts):
        text = text or ""
        words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\s]+", text, re.ASCII)]
        spans = [x for k in kinds for x in entities(text)[k]]
        tries = [m.span() for m in re.finditer(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}|(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])", text)]
        over = lambda w, found: any(a < w[2] and b > w[1] for a, b in found)
        hit = [over(w, spans) for w in words]
        for i, (w, at, _) in enumerate(words):
            if not hit[i] and not re.search("[0-9]", w):
                continue
            get = lambda j: words[j][0].lower() if 0 <= j < len(words) else None
            l1, r1 = (None if hit[i] and 0 <= j < len(words) and hit[j] else get(j) for j in (i - 1, i + 1))
            around = [("l", l1), ("r", r1), ("ll", l1 and get(i - 2), l1), ("rr", r1, r1 and get(i + 2)), ("lr", l1, r1)]
            core = re.sub(r"^[\W_]+|[\W_]+$", "", w)
            start = at + len(re.match(r"[\W_]*", w).group())
            failed = over(words[i], [t for t in tries if t not in spans])
            like = not hit[i] and len(core) >= 8 and len(re.sub("[^0-9]", "", core)) >= 4 and (not failed or any(c.isalpha() for c in core))
            secret = len(core) >= 32 and re.fullmatch("[A-Za-z0-9+/_-]+", core) and re.search("[0-9]", core) and re.search("[A-Za-z]", core)
            slots.append((nth, start, start + len(core), core, hit[i] or bool(secret), like, [p for p in around if None not in p]))
    edges = defaultdict(int)
    seeds, like = set(), set()
    for _, _, _, core, seed, ok, around in slots:
        for p in around:
            edges[p, core] += 1
            if seed:
                seeds.add(core)
            if ok:
                like.add(core)
    score = {c: float(c in seeds) for _, c in edges}
    k, confident_before = 0, -1
    while True:
        k += 1
        total, good, sure = defaultdict(int), defaultdict(float), defaultdict(int)
        for (p, c), n in edges.items():
            total[p] += n
            good[p] += n * score[c]
            sure[p] += n * (score[c] == 1)
        value = {p: good[p] / total[p] for p in total if sure[p] > 0}
        trusted = {p for p, v in value.items() if sure[p] >= support and v >= confident}
        if k >= least_rounds and len(trusted) == confident_before:
            break
        confident_before = len(trusted)
        fresh, number = defaultdict(float), defaultdict(int)
        known = set(seeds)
        for (p, c), n in edges.items():
            fresh[c] += n * value.get(p, 0.0)
            number[c] += n
            if p in trusted and c in like:
                known.add(c)
        score = {c: 1.0 if c in known else min(0.999, fresh[c] / number[c]) for c in score}
    out = defaultdict(set)
    for nth, s, e, _, _, ok, around in slots:
        if ok and any(p in trusted for p in around):
            out[nth].add((s, e))
    return {k: sorted(v) for k, v in out.items()}
