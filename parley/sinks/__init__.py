"""Writers: the only place where jobs are triggered."""
