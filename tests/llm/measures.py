"""Precision and recall at a threshold, and the chance that a positive row scores above a negative one."""

import numpy as np


def scores(rows, threshold):
    score, label = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hit = score >= threshold
    positive, negative = np.sort(score[label == 1]), np.sort(score[label == 0])
    below = (np.searchsorted(negative, positive) + np.searchsorted(negative, positive, "right")) / 2
    return label[hit].mean(), hit[label == 1].mean(), below.mean() / len(negative)
