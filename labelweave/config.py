"""Settings of a run, and the presets in use."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Augmentation:
    """How far an address order is disturbed before its text is built."""

    shuffle: float = 0.0
    duplicate: float = 0.0
    delete: float = 0.0
    profile: str = "standard"
    seed: int = 0


# Per-file and per-upload preparation disturb orders in all three ways, the
# folder and local jobs only shuffle, and sample data keeps its order.
PRESETS = {
    "full": Augmentation(shuffle=0.2, duplicate=0.2, delete=0.2),
    "shuffle_only": Augmentation(shuffle=0.2),
    "none": Augmentation(),
}
