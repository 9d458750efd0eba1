"""A plain restatement of the scoring rules, to compare with on small fixtures."""

import re


def words(text, stop):
    return {w for w in re.findall("[a-z0-9&]+", text.lower()) if len(w) > 1 and w not in stop}


def candidates(text, leaves, stop, synonyms, top_n):
    low, query = text.lower(), words(text, stop)
    extra = [syn for key, syn in synonyms.items() if (key in low if " " in key else key in query)]
    query = query.union(*extra)
    scores = {}
    for ordinal, l1, l2, l3, l4, _, note in leaves:
        by_level = [(note, 8), (l4, 5), (l3, 3), (l2, 2), (l1, 1)]
        scores[ordinal] = sum(points * len(query & words(part, stop)) for part, points in by_level)
        scores[ordinal] += 10 * bool(l4 and l4.lower() in low) + 7 * bool(l3 and l3.lower() in low)
    best = max(scores.values())
    if best < 3:
        seen, chosen = {}, []
        for leaf in leaves:
            seen[leaf[1]] = seen.get(leaf[1], 0) + 1
            if seen[leaf[1]] <= 2:
                chosen.append((leaf[0], None))
        return "weak", chosen
    size = min(top_n, 7) if best >= 8 else min(max(top_n, 10), 12)
    ranked = sorted(scores.items(), key=lambda item: (-item[1], item[0]))[:size]
    return ("strong" if best >= 8 else "moderate"), ranked
