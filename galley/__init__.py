"""DataFrame operators and jobs for collections of articles."""
