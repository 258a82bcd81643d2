"""Slow, obvious versions of the operators, for comparison on small inputs."""

from __future__ import annotations

from collections import Counter


def plain_merges(segments: dict[str, int], n_merges: int, cap: int = 16) -> list[tuple[str, str]]:
    """One merge at a time: count, choose, apply."""
    words = {w: list(w) for w in segments}
    pieces = {c for w in segments for c in w}
    merges = []
    while len(merges) < n_merges:
        counts = Counter()
        for w, symbols in words.items():
            for pair in zip(symbols, symbols[1:]):
                counts[pair] += segments[w]
        allowed = [p for p in counts if len(p[0] + p[1]) <= cap and p[0] + p[1] not in pieces]
        if not allowed:
            break
        best = min(allowed, key=lambda p: (-counts[p], p))
        merges.append(best)
        pieces.add(best[0] + best[1])
        for w, symbols in words.items():
            out, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i : i + 2]) == best:
                    out.append(best[0] + best[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            words[w] = out
    return merges


def plain_encode(text: str, piece_ids: dict[str, int]) -> list[int]:
    words = [w for w in text.split(" ") if w]
    if not words:
        return []
    marked = "".join("▁" + w for w in words)
    ids = []
    for part in ("▁" + p for p in marked.split("▁")[1:]):
        symbols = list(part)
        while True:
            options = [
                (piece_ids[a + b], i)
                for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                if a + b in piece_ids
            ]
            if not options:
                break
            _, i = min(options)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        for s in symbols:
            ids += [piece_ids[s]] if s in piece_ids else [3 + b for b in s.encode()]
    return ids


def plain_chunks(stream: list[int], context: int) -> list[list[int]]:
    return [
        stream[i * context : i * context + context + 1] for i in range(len(stream) // context - 1)
    ]


def plain_ema(values: list[float], decay: float, skip: int) -> list[float]:
    out, r = [], None
    for v in values[skip:]:
        r = v if r is None else decay * r + (1 - decay) * v
        out.append(r)
    return out
