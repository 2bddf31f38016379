"""Session settings and the staged training-set job (Q19)."""

from revlens.plans.session import build_session, checkpoint_dir
from revlens.plans.training_set import build_training_set

__all__ = ["build_session", "build_training_set", "checkpoint_dir"]
