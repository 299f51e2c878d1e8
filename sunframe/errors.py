"""Typed errors, one for each guard."""

from __future__ import annotations


class SunframeError(Exception):
    """Base of all errors that this package raises on purpose."""


class ConfigError(SunframeError):
    """A setting has no such value."""


class ResolutionError(ConfigError):
    """The resolution is none of those offered."""


class MissingDataError(SunframeError):
    """The raw table is not where the configuration says."""


class MissingExpandedError(SunframeError):
    """An expanded table is to be imported that was never built and saved."""


class MissingFeatureError(SunframeError):
    """A table lacks a column that is asked for."""
