"""Errors raised on the driver, before any job that scores rows is started."""


class ModelError(ValueError):
    """The model tables are missing, ambiguous or not a valid forest."""


class InputError(ValueError):
    """The DataFrame does not offer what the model's inputs ask for."""
