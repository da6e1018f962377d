"""Audio arrays and time: activity, masking, CTC alignment, chunking. Kernels are numpy on plain arrays."""

from __future__ import annotations

import numpy as np


def energy_vad(samples: np.ndarray, rate: int, window: float = 0.03, ratio: float = 0.5, floor: float = 0.002) -> list[tuple[float, float]]:
    """Active intervals: windows whose RMS reaches the floor and a share of the whole RMS, merged."""
    step = max(1, int(rate * window))
    n = -(-len(samples) // step)
    if not n:
        return []
    padded = np.zeros(n * step)
    padded[: len(samples)] = samples
    size = np.full(n, step)
    size[-1] = len(samples) - (n - 1) * step
    rms = np.sqrt((padded.reshape(n, step) ** 2).sum(axis=1) / size)
    active = rms >= max(floor, ratio * np.sqrt((padded**2).sum() / len(samples)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], active, [False])).astype(int)))
    return [(a * step / rate, min(len(samples), b * step) / rate) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def ctc_align(log_probs: np.ndarray, tokens: list[int], blank: int = 0) -> list[tuple[int, int, float]]:
    """(first frame, frame behind the last, mean probability) of each token on the best monotone path."""
    frames, n = len(log_probs), len(tokens)
    if not n or frames < n:
        return []
    score = np.full((frames + 1, n + 1), -np.inf)
    score[0, 0] = 0.0
    score[1:, 0] = np.cumsum(log_probs[:, blank])
    for t in range(frames):
        stay = score[t, 1:] + np.maximum(log_probs[t, blank], log_probs[t, tokens])
        move = score[t, :-1] + log_probs[t, tokens]
        score[t + 1, 1:] = np.maximum(stay, move)
    out, t, j = [], frames, n
    end = np.zeros(n, dtype=int)
    probs: list[list[float]] = [[] for _ in tokens]
    first = np.zeros(n, dtype=int)
    while j > 0:
        move = score[t - 1, j - 1] + log_probs[t - 1, tokens[j - 1]]
        stay = score[t - 1, j] + max(log_probs[t - 1, blank], log_probs[t - 1, tokens[j - 1]])
        held = log_probs[t - 1, tokens[j - 1]] >= log_probs[t - 1, blank] or move >= stay
        if held:
            end[j - 1] = max(end[j - 1], t)
            probs[j - 1].append(float(np.exp(log_probs[t - 1, tokens[j - 1]])))
        if move >= stay:
            first[j - 1] = t - 1
            j -= 1
        t -= 1
    for k in range(n):
        out.append((int(first[k]), int(end[k]), float(np.mean(probs[k]))))
    return out


def chunk(intervals: list[tuple[float, float]], target: float = 12.0, most: float = 30.0, least: float = 0.25, pause: float = 0.35, depth: int = 10) -> list[tuple[float, float]]:
    """Cuts a block of activity, intervals by start, into chunks: a tree of cuts in the middle of pauses.

    A stretch of over ``most`` seconds is cut where twice the pause (``pause`` at least) less 0.35 of the cut's distance from ``target`` seconds is most,
    with 5 less for each side that stays over ``most``; each side has at least ``least``. Without such a pause it is cut at the target. Stretches
    of under ``least`` go, and those ``depth`` cuts down stay whole.
    """
    out: list[tuple[float, float]] = []
    if not intervals:
        return out
    stretches = [(intervals[0][0], intervals[-1][1], np.array(intervals, float).reshape(-1, 2), 0)]
    while stretches:
        start, end, own, cuts = stretches.pop()
        if end - start < least:
            continue
        if cuts > depth or end - start <= most:
            out.append((start, end))
            continue
        gap, at = own[1:, 0] - own[:-1, 1], (own[1:, 0] + own[:-1, 1]) / 2
        worth = 2 * gap - 0.35 * np.abs(at - start - target) - 5.0 * (at - start > most) - 5.0 * (end - at > most)
        worth[(gap < pause) | (at - start < least) | (end - at < least)] = -np.inf
        if len(worth) and worth.max() > -np.inf:
            cut = float(at[int(worth.argmax())])
        else:
            cut = min(start + target, end - least)
            if not start < cut < end:
                out.append((start, end))
                continue
        left, right = own[own[:, 1] <= cut], own[own[:, 0] >= cut]
        stretches.append((cut, end, right if len(right) else np.array([(cut, end)]), cuts + 1))
        stretches.append((start, cut, left if len(left) else np.array([(start, cut)]), cuts + 1))
    return out
