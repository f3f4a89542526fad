"""Errors of the query language."""


class MqlError(Exception):
    """Any error in a query; position is that of the offending text, where there is one."""

    def __init__(self, message: str, position: int | None = None):
        super().__init__(message if position is None else f"{message} (position={position})")
        self.position = position


class MqlSyntaxError(MqlError):
    """The text does not follow the grammar."""


class MqlSemanticError(MqlError):
    """The text follows the grammar but asks for something that is not there."""
