"""functions of seqloom."""
