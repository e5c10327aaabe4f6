"""ambermill.quality"""
