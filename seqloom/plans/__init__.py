"""plans of seqloom."""
