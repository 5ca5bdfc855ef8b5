"""Where the public vocabulary files lie."""

import public_tokenizers


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def word_pattern() -> str:
    """The pattern by which byte-level vocabularies part a text before merging."""
    return public_tokenizers.PATTERN
