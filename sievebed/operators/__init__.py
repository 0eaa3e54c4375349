"""DataFrame-in / DataFrame-out building blocks.  None of them starts a job."""
