"""Where the files of public tokenizers are."""

from __future__ import annotations

import os


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file; ``SEQLOOM_TOKENIZERS`` names another folder."""
    return os.path.join(os.environ.get("SEQLOOM_TOKENIZERS", "/opt/tokenizers"), name)
