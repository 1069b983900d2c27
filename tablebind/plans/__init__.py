"""Shared plan shapes: ordered groups without a single hot task, sized joins, checkpoints."""
