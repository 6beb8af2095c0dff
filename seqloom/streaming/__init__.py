"""streaming of seqloom."""
