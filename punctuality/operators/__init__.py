"""DataFrame -> DataFrame operators. None runs a job, except where a model is fitted."""
