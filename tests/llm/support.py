"""Small tables with every odd case, and brute-force versions of the operators."""

import re

LONG = "lorem " * 40_000
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, id string, key int, u string"


def documents(spark, texts, **more):
    """Documents with extra columns whose names the operators use inside."""
    rows = []
    for i, text in enumerate(texts):
        lang, source = more.get("lang", ["en"] * len(texts))[i], more.get("source", ["a"] * len(texts))[i]
        number = more.get("ids", range(len(texts)))[i]
        rows.append((number, text, lang, source, len(text or ""), f"row {i}", "x", i, "y"))
    return spark.createDataFrame(rows, DOCUMENTS)


def shingle_set(text):
    words = [w for w in re.split("[ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def smallest_reachable(nodes, linked):
    """For each node the smallest one it can reach."""
    group = {n: n for n in nodes}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in linked:
        x, y = root(a), root(b)
        group[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def near_by_hand(pairs):
    """(set size, component) by id, from (id, text)."""
    sets = {i: shingle_set(t) for i, t in pairs}
    posting = {}
    for i, s in sets.items():
        for x in s:
            posting.setdefault(x, []).append(i)
    common = {}
    for members in posting.values():
        for k, a in enumerate(members):
            for b in members[k + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    linked = [(a, b) for (a, b), c in common.items() if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c)]
    component = smallest_reachable(sets, linked)
    return {i: (len(s), component[i]) for i, s in sets.items()}


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_by_hand(text):
    out = []
    for kind, expression in BASE.items():
        for m in re.finditer(expression, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            passes = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if passes:
                out.append((kind, m.start(), m.end()))
    return out
