"""Weights given by a formula, so that the graph model can be checked against SQL."""

from __future__ import annotations

import numpy as np

from agora.catalog import Profile
from agora.operators.sage import Parameters, parameter_shapes


def closed_form_weights(profile: Profile, hidden: int = 2) -> Parameters:
    """Entry k of the n-th weight array is ``((7 n + 3 k) mod 11 - 4) / 10``."""
    weights = {}
    for n, (name, shape) in enumerate(parameter_shapes(profile, 1, hidden, 2).items()):
        k = np.arange(int(np.prod(shape)))
        weights[name] = (((7 * n + 3 * k) % 11 - 4) / 10).reshape(shape)
    return weights
