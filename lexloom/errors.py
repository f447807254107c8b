"""Errors of the engine. Guards refuse by raising; they never warn."""


class CorpusError(Exception):
    """Base of all errors here."""


class GuardViolationError(CorpusError):
    """A data-quality guard refuses."""


class LicenceViolationError(GuardViolationError):
    """A provider's licence doesn't permit the use."""


class AutophagyError(GuardViolationError):
    """An internal provider would feed induction."""


class HoldoutSealError(GuardViolationError):
    """The held-out names don't match their seal."""


class AcquisitionError(CorpusError):
    """A source can't be fetched."""


class SnapshotValidationError(CorpusError):
    """A snapshot is damaged or shrank."""


class SchemaContractError(CorpusError):
    """A file's header doesn't bind the fields that are needed."""


class ArtifactSchemaError(CorpusError):
    """An artifact has an unknown schema."""


class CorpusConfigError(CorpusError):
    """The configured paths can't be used."""
