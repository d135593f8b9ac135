"""Plain-Python versions of what the operators compute, and awkward rows."""

import hashlib
import math
import re
from collections import defaultdict

ODD = [
    (1, None), (2, ""), (3, "Just a few words here."), (3, "Just a few words here."), (4, "long " * 30_000 + "end. " + "x" * 50_000), (5, " \n\t "), (6, "Ünï¢ødé ŧëxt 漢字 🎉 token: abcdef1 !!"),
    (None, "No id, but a text of several words. And a second sentence follows it."), (7, "No id, but a text of several words. And a second sentence follows it."), (8, "Released under the MIT License."),
]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def jaccard_roots(texts, least=0.8, width=5):
    words = [(t or "").split() for t in texts]
    sets = [{tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for w in words]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            alike = sets[i] == sets[j] or len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9
            if alike and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def brute_matches(texts, items, width=10):
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    index = defaultdict(set)
    for i, text in items:
        words = find(text)
        for k in range(len(words) - width + 1) if len(words) >= width else range(bool(words)):
            index[tuple(words[k : k + width])].add(str(i))
    out = []
    for i, text in texts:
        words, hit, names = find(text), set(), set()
        for n in {len(k) for k in index}:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in index:
                    hit.update(range(k, k + n))
                    names |= index[w]
        out.append((i, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def _level(line):
    m = re.match(r"((?:[ \t]?>)+)[ \t]?", line)
    return (m[1].count(">"), line[m.end() :]) if m else (0, line)


def _normal(text):
    return re.sub(r"\s+", " ", text.lower()).strip(" ")


def _own(text):
    if not re.search(r"(?m)^[ \t]?>", text):
        return text
    lines = text.split("\n")
    tells = re.compile(r"\b(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$", re.I)
    kept = [x for i, x in enumerate(lines) if not _level(x)[0] and not (tells.search(x) and i + 1 < len(lines) and _level(lines[i + 1])[0])]
    return "\n".join(kept).strip()


def conversations(rows, least_line=12):
    """(conv_id, turn, role, own text, reply_to, position, passages, linked, depth) of each (conv_id, turn, role, text)."""
    rows = [(c, t, r, x or "") for c, t, r, x in rows]
    said = {}
    for c, t, _, x in rows:
        if c is None or t is None:
            continue
        own = _own(x)
        for unit in [own, *re.split(r"\n\s*\n", own), *own.split("\n")]:
            key = (c, _normal(unit))
            if key[1]:
                said[key] = min(said.get(key, t), t)
    quotes = {}
    for row in rows:
        c, t, _, x = row
        runs = []
        for line in x.split("\n"):
            level, bare = _level(line)
            if runs and runs[-1][0] == level:
                runs[-1][1].append(bare)
            else:
                runs.append((level, [bare]))
        found = []
        for level, lines in runs:
            units = [(True, _normal("\n".join(lines)))] + [(False, _normal(x)) for x in lines if len(_normal(x)) >= least_line]
            units = [u for u in units if u[1]]
            if not level or not units:
                continue
            hits = [(whole, said[c, u]) for whole, u in units if t is not None and (c, u) in said and said[c, u] < t]
            found.append((level, max(hits)[1] if hits else None))
        quotes[row] = found
    linked = {}
    for (c, t, _, _), found in quotes.items():
        hits = [(level, -o) for level, o in found if o is not None]
        if hits:
            linked[c, t] = max(linked.get((c, t), -1), -min(hits)[1])
    place, reply = {}, {}
    for c in {r[0] for r in rows} - {None}:
        turns = sorted({r[1] for r in rows if r[0] == c and r[1] is not None})
        order = []
        for k, t in enumerate(turns):
            before = turns[k - 1] if k else None
            reply[c, t] = linked.get((c, t), before)
        # A chain goes on from the turn before; an opened branch stands right after what it replies to.
        opens = {t for k, t in enumerate(turns) if k and reply[c, t] < turns[k - 1]}
        kids = {}
        for t in opens:
            kids.setdefault(reply[c, t], []).append(t)
        goes_on = {a: b for a, b in zip(turns, turns[1:]) if b not in opens}  # noqa: B905
        stack = turns[:1]
        while stack:
            t = stack.pop()
            order.append(t)
            stack += ([goes_on[t]] if t in goes_on else []) + sorted(kids.get(t, []), reverse=True)
        place.update({(c, t): k for k, t in enumerate(order)})
    return [(c, t, r, _own(x), reply.get((c, t)), place.get((c, t)), len(quotes[c, t, r, x]), sum(o is not None for _, o in quotes[c, t, r, x]), max((n for n, _ in quotes[c, t, r, x]), default=0)) for c, t, r, x in rows]


def battery(run, alphabet, letters, pairs=None):
    """-log10 of the combined p-values of "drawn evenly from the alphabet", character by character."""
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi2 = lambda x, df: tail(((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    kind = lambda c: "d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "o"
    sound = lambda c: ("v" if c.lower() in "aeiouy" else "c") if c.isalpha() else "o"
    n, k = len(run), len(alphabet)
    members = {t: [c for c in alphabet if kind(c) == t] for t in "ludo"}
    members = {t: sorted(v, key=lambda c: letters.index(c.lower())) if t in "lu" else v for t, v in members.items() if v}
    tests, between, within, free = [], 0, 0, 0
    for t, own in members.items():
        got = [c for c in run if kind(c) == t]
        between += (len(got) - n * len(own) / k) ** 2 / (n * len(own) / k)
        pools = 4 if len(got) >= 20 else 2 if len(got) >= 10 else 0
        if pools and t != "o":
            for p in range(pools):
                inside = [c for i, c in enumerate(own) if i * pools // len(own) == p]
                wanted = len(got) * len(inside) / len(own)
                within += (sum(c in inside for c in got) - wanted) ** 2 / wanted
            free += pools - 1
    tests.append(chi2(between, len(members) - 1) if len(members) > 1 else 1)
    tests.append(chi2(within, free) if free else 1)
    for f in (kind, sound):
        shares = [sum(f(c) == t for c in alphabet) / k for t in {f(c) for c in alphabet}]
        a, b = sum(p**2 for p in shares), sum(p**3 for p in shares)
        if len(shares) > 1:
            same = sum(f(x) == f(y) for x, y in zip(run, run[1:]))  # noqa: B905
            tests.append(2 * tail(abs(same - (n - 1) * a) / math.sqrt((n - 1) * a * (1 - a) + 2 * (n - 2) * (b - a**2))))
    at = [alphabet.index(c) - (k - 1) / 2 for c in run]
    tests.append(2 * tail(abs(sum(x * y for x, y in zip(at, at[1:]))) * 12 / (k * k - 1) / math.sqrt(n - 1)))  # noqa: B905
    if pairs:
        own = sorted({c.lower() for c in alphabet if c.isalpha()})
        total = sum(pairs.get(a + b, 0) for a in own for b in own)
        score = lambda a, b: math.log((pairs.get((a + b).lower(), 0) + 1) * len(own) ** 2 / (total + len(own) ** 2)) if a.isalpha() and b.isalpha() else 0.0
        every = [score(a, b) for a in alphabet for b in alphabet]
        mean = sum(every) / k**2
        shared = sum(score(a, b) * score(b, c) for a in alphabet for b in alphabet for c in alphabet) / k**3 - mean**2 if k < 40 else None
        if shared is None:  # the middle character splits the sum
            shared = sum(sum(score(a, b) for a in alphabet) * sum(score(b, c) for c in alphabet) for b in alphabet) / k**3 - mean**2
        variance = sum(x * x for x in every) / k**2 - mean**2
        together = sum(score(a, b) for a, b in zip(run, run[1:]))  # noqa: B905
        tests.append(tail((together - (n - 1) * mean) / math.sqrt((n - 1) * variance + 2 * (n - 2) * shared)))
    return -math.log10(max(1e-300, chi2(-2 * sum(math.log(max(t, 1e-300)) for t in tests), 2 * len(tests))))


def benjamini_hochberg(p, weights, fdr):
    """Which hypotheses the weighted step-up procedure rejects."""
    q = sorted((x / w, i) for i, (x, w) in enumerate(zip(p, weights, strict=True)))
    last = max((k for k, (x, _) in enumerate(q, 1) if len(p) * x <= fdr * k), default=0)
    return {i for _, i in q[:last]}
