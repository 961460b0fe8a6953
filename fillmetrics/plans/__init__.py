"""Jobs: the parts that read, write and decide what to run."""
