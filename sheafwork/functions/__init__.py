"""Column-level building blocks."""

from sheafwork.functions.markup import (
    blank_to_null,
    escape,
    first_group,
    plain,
    plain_fragment,
    squeeze,
    unescape,
    without_hidden,
)
from sheafwork.functions.paths import join_path

__all__ = [
    "blank_to_null",
    "escape",
    "first_group",
    "join_path",
    "plain",
    "plain_fragment",
    "squeeze",
    "unescape",
    "without_hidden",
]
