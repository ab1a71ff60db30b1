"""The workers' path, under the name that this package uses."""

from smogline.session import findable

__all__ = ["findable"]
