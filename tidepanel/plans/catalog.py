"""All registered queries by name."""

from tidepanel.plans import features, models, panels, production, scores, tables  # noqa: F401  they fill the register
from tidepanel.plans.base import REGISTER, Query


def catalog() -> dict[str, Query]:
    return dict(sorted(REGISTER.items()))
