"""Positive-unlabelled naive Bayes by expectation-maximization over words and pairs of words of short passages.

Trusted passages keep their label; the posteriors of the others, the rates of the features and the class
weight are re-estimated until they settle. No single feature weighs more than ``MOST_ODDS``, as a bounded
sample may lack a usual word; features it lacks speak mildly against the class, which is stereotyped.
"""

from __future__ import annotations

import math
import re

import numpy as np

ROUNDS = 30
#: Pseudo-counts of a feature outside and inside the class.
OTHER_PSEUDO, CLASS_PSEUDO = 1.0, 0.05
#: Pseudo-count inside the class in terms of the classes' ratio, at most: a feature the class lacks then speaks for it only
#: where it is rare outside as well, so the class does not grow over the usual words of a small table.
RARE = 5.0
#: Log odds of one feature, at most; log odds of a word and of a pair of words the sample lacks.
MOST_ODDS = 5.0
NEW_WORD, NEW_PAIR = -2.0, -0.7

FEATURE = re.compile(r"<blank>|<n>|<name>|[^\W\d_]+|[/\\{}=;|]")
WEAK = {"^", "$", "<n>", "<name>"}


def features(passage: str) -> list[str]:
    """Distinct words, pairs of neighbours and the passage as a whole; several passages are lines."""
    out: dict[str, None] = {}
    for line in passage.lower().split("\n"):
        w = FEATURE.findall(line)
        out.update(dict.fromkeys(w))
        out.update(dict.fromkeys(f"{a} {b}" for a, b in zip(["^", *w], [*w, "$"]) if a not in WEAK or b not in WEAK))
        out["= " + " ".join(w)] = None
    return list(out)


class Model:
    """Log odds of features and of the classes."""

    def __init__(self, positive: dict[str, float], unlabelled: dict[str, float], repeated: set[str], content: re.Pattern | None = None):
        """Distinct passages with their weighted counts, those of them that occur more than once, and the form of
        passages that are none of the class whatever they say."""
        self.content = content
        texts = [*positive, *unlabelled]
        times = np.array([*positive.values(), *unlabelled.values()], float)
        self.odds: dict[str, float] = {}
        self.prior = -math.inf
        if not positive or not unlabelled:
            return
        ids: dict[str, int] = {}
        flat, size = [], []
        for t in texts:
            fs = [ids.setdefault(f, len(ids)) for f in features(t)]
            flat += fs
            size.append(len(fs))
        x = np.array(flat, np.int64)
        row = np.repeat(np.arange(len(texts)), np.array(size))
        label = np.zeros(len(texts))
        label[: len(positive)] = 1.0
        fixed = label > 0
        fixed[len(positive) :] = [self._ruled_out(t) for t in unlabelled]
        # a feature of a single unlabelled occurrence is as good as new, else it would speak for its own passage
        known = np.array([t in repeated for t in texts]) | fixed
        lone = (np.bincount(x, minlength=len(ids)) == 1) & (np.bincount(x, weights=known[row], minlength=len(ids)) == 0)
        new_odds = np.array([_new(f) for f in ids])
        post = label.copy()
        for _ in range(ROUNDS):
            pos, neg = (np.bincount(x, weights=(times * w)[row], minlength=len(ids)) for w in (post, 1 - post))
            n_pos, n_neg = (times * post).sum(), (times * (1 - post)).sum()
            rare = min(CLASS_PSEUDO, RARE * n_pos / max(n_neg, 1.0))
            odds = np.log((pos + rare) / (n_pos + 2 * rare)) - np.log((neg + OTHER_PSEUDO) / (n_neg + 2 * OTHER_PSEUDO))
            odds = np.where(lone, new_odds, np.clip(odds, -MOST_ODDS, MOST_ODDS))
            prior = math.log(n_pos / n_neg) if n_neg > 0 else 0.0
            score = np.bincount(row, weights=odds[x], minlength=len(texts)) + prior
            new = np.where(fixed, label, 1 / (1 + np.exp(-np.clip(score, -50, 50))))
            done = np.abs(new - post).max() < 1e-3
            post = new
            if done:
                break
        self.odds = {f: float(odds[i]) for f, i in ids.items()}
        self.prior = prior

    def _ruled_out(self, passage: str) -> bool:
        return self.content is not None and self.content.match(passage) is not None

    def score(self, passage: str) -> float:
        if self._ruled_out(passage):
            return -math.inf
        return self.prior + sum(self.odds[f] if f in self.odds else _new(f) for f in features(passage))

def _new(feature: str) -> float:
    """Log odds of a feature the sample lacks."""
    return 0.0 if feature[0] == "=" else NEW_PAIR if " " in feature else NEW_WORD
