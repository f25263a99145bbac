"""Plain models of the operators, for small tables only."""

import hashlib
import math
import re

ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
SECRET_KINDS = ("assign", "access", "hex", "entropy")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in (window.count(x) for x in set(window)))


def all_secrets(text, settings):
    base, found = base_secrets(text), set()
    for candidate in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        if any(re.search(p, candidate[0]) for p in settings.allowed):
            continue
        spans = set()
        for kind in settings.classes:
            for run in re.finditer(kind.run, candidate[0]):
                merged = []
                for i in range(len(run[0]) - settings.window + 1):
                    if entropy(run[0][i:i + settings.window]) >= kind.bits - 1e-9:
                        if merged and merged[-1][1] >= i:
                            merged[-1][1] = i + settings.window
                        else:
                            merged.append([i, i + settings.window])
                at = candidate.start() + run.start()
                spans |= {(at + b, 3, at + e) for b, e in merged}
        found |= {s for s in spans if not any(o != s and o[0] <= s[0] and o[2] >= s[2] for o in spans)}
    added = [s for s in found if not any(b[0] <= s[0] and b[2] >= s[2] for b in base)]
    return sorted(base + added)


def span_text(spans):
    return ",".join(f"{SECRET_KINDS[k]}:{s}:{e}" for s, k, e in spans)


def words_of(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def overlaps(text, item, settings):
    """(shift, start, end) of every shift at which a mask fits and the words around agree."""
    a, b, span, found = words_of(text), words_of(item), settings.span, {}
    for i in range(len(a) - span + 1):
        for j in range(len(b) - span + 1):
            if not any(all(a[i + k] == b[j + k] for k, bit in enumerate(m) if bit == "1") for m in settings.masks):
                continue
            left = min(settings.flank, i, j)
            right = min(span + settings.flank, len(a) - i, len(b) - j)
            equal = sum(a[i + k] == b[j + k] for k in range(-left, right))
            if equal >= settings.agree * (left + right):
                s, e = found.get(i - j, (i - left, i + right))
                found[i - j] = (min(s, i - left), max(e, i + right))
    return sorted((k, *v) for k, v in found.items())
