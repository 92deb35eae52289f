"""What the engine raises."""


class EngineError(Exception):
    """Any failure that the engine names itself."""


class InputError(EngineError, ValueError):
    """An argument or a table that an operator cannot take."""


class MissingRowsError(InputError):
    """A join that must match did not; names the first keys."""


class StoreNotReadyError(EngineError):
    """A table that a service needs does not exist."""


class TargetExistsError(EngineError):
    """A sink's target is there and may not be replaced."""


class QualityError(InputError):
    """Rows break a declared rule."""


class BackendError(EngineError):
    """A model behind a hook failed."""


class TransientBackendError(BackendError):
    """A failure worth another try."""


class IncompleteError(EngineError):
    """Fewer keys are done than there should be."""


class LayoutError(InputError):
    """A dataset's folders are not laid out as they should be."""


class AlignmentError(InputError):
    """Two artifacts that belong together differ in order or number."""


class ModelConfigError(EngineError):
    """A model is set up in a way that it cannot run."""
