"""Every operator of the engine, run on the supplied tables."""
