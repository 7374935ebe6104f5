"""Loading as files arrive."""
