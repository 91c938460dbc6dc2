"""Errors the driver-side functions raise."""


class ReportLacksFields(LookupError):
    """A platform's report does not have fields that its silver rows are made of."""

    def __init__(self, platform: str, fields: list[str], where: str) -> None:
        self.platform, self.fields, self.where = platform, sorted(fields), where
        names = ", ".join(self.fields)
        super().__init__(f"no {names} in the {platform} report {where or '(not on storage)'}")


class NothingToWrite(ValueError):
    """A stage's item has no rows."""


class QualityGateError(ValueError):
    """At least one validated source failed a quality rule."""


class StaleWriter(RuntimeError):
    """Somebody else has committed a newer version since this writer read its own."""

    def __init__(self, root: str, version: int) -> None:
        super().__init__(f"{root} has moved on from version {version}; nothing was changed, load again")


class SchemaDrift(ValueError):
    """The files of a snapshot have schemas that no common one holds."""

    def __init__(self, path: str, faults: list[str]) -> None:
        self.path, self.faults = path, faults
        super().__init__(f"{path} cannot be read as one table: " + " | ".join(faults))
